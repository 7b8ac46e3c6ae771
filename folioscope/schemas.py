"""Row types of the evidence model: one canonical claim schema, whatever container a digest uses."""

from __future__ import annotations

RECORD = (
    "record_key string, title string, date string, creators array<string>, source_type string, reference string, schema_version string, "
    "metadata map<string,string>, body string, pages array<struct<file_page:int,offset:int>>"
)
CHAIN = "struct<origin_kind:string,origin:string,origin_ref:string,relay:array<string>>"
REF = "struct<id:string,name:string,role:string>"
CLAIM = (
    "digest_key string, claim_id string, category string, type string, attestation string, speaker struct<id:string,name:string>, "
    f"provenance_chain {CHAIN}, attribution_in_text boolean, location string, date string, date_range array<string>, refs array<{REF}>, "
    "quote string, text string, entailment struct<label:string,score:double,model:string,premise:string>, ord struct<chunk:int,round:int,pos:int>"
)
NODE = "digest_key string, node_id string, node_type string, name string, metadata map<string,string>"
USAGE = (
    "digest_key string, stage string, model string, tokens struct<input:bigint,output:bigint,cache_read:bigint,cache_write:bigint,calls:int>, "
    "notional_cost_usd double, duration_s double"
)
WORD = "record_key string, pos int, word string, at double, axis string"
ACCOUNT = "record_key string, account_id string, title string, subject string, `when` string, `where` string, span_start string, span_end string, also_spans array<struct<start:string,end:string>>, teller_role string"

# The model's enumerations.
CLAIM_TYPES = ("observation", "testimony", "hearsay", "opinion", "measurement", "administrative")
ATTESTATIONS = ("first_hand", "second_hand", "third_hand")
NODE_TYPES = ("person", "organisation", "project", "place", "event", "object", "document", "topic")
ROLES = ("subject", "participant", "setting", "mentioned")
TELLER_ROLES = ("experienced", "investigated", "was_told", "briefed_or_read", "unclear")
ORIGIN_KINDS = ("speaker", "named", "anonymous", "document", "unattributed")
VERDICTS = ("entails", "neutral", "contradicts")
DECISIONS = ("accept", "adjust", "split", "reject", "defer")
MEDIA_FAMILY = {"video": "spoken", "audio": "spoken", "ebook": "document", "pdf": "document", "web": "document", "email": "document"}
OPEN_RIGHTS = ("public_domain", "open_licence")
OTHER_RIGHTS = ("publicly_accessible", "licensed", "restricted")
