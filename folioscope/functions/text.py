"""Scalar text functions as Catalyst expressions. Regexes use explicit ASCII classes, so SQL engines agree on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no content in account scores, and in loose name matches.
STOPWORDS = "a an and at by for from in into near of on the to two who with".split()
LOOSE_STOPWORDS = "the a an of for to in on and or by with re at as from about into".split()
# Ranks before a name, and plural node types.
RANKS = "dr mr mrs ms prof professor president senator sir the".split()
TYPES = {
    "people": "person",
    "persons": "person",
    "organisations": "organisation",
    "organizations": "organisation",
    "places": "place",
    "events": "event",
    "matters": "matter",
    "objects": "object",
    "documents": "document",
    "concepts": "concept",
    "records": "record",
}
# Node types whose names are phrased in many ways.
LOOSE_TYPES = ("event", "document", "concept")
# Capitalised words that open sentences and name nobody.
OPENERS = (
    "The A An This That These Those It He She They There Here When Then But And So If As At In On Of To We You I "
    "His Her Their What Who Why How Because Since After Before"
).split()


def lowered(c: Column) -> Column:
    """A-Z only: SQL engines differ on the rest."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(c: Column) -> Column:
    """Runs of a-z and 0-9 of the lowered text."""
    return F.regexp_extract_all(lowered(c), F.lit("[a-z0-9]+"), F.lit(0))


def content_tokens(c: Column) -> Column:
    """Distinct tokens without possessives, stopwords and plural s (of words longer than four)."""
    bare = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("'s"), F.lit(""))
    kept = F.filter(F.regexp_extract_all(bare, F.lit("[a-z0-9]+"), F.lit(0)), lambda t: ~t.isin(STOPWORDS))
    return F.array_distinct(F.transform(kept, lambda t: F.when((F.length(t) > 4) & t.endswith("s"), t.substr(F.lit(1), F.length(t) - 1)).otherwise(t)))


def loose_tokens(c: Column) -> Column:
    """Distinct words of three characters or more of the normal form, years among them, without stopwords."""
    return F.array_distinct(F.filter(F.split(name_normal(c), " "), lambda t: (F.length(t) >= 3) & ~t.isin(LOOSE_STOPWORDS)))


def dice(a: Column, b: Column) -> Column:
    """2·|∩| / (|a| + |b|), 0 for empty sets."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[ \\t\\r\\n]+", " "))


def straight_quotes(c: Column) -> Column:
    return F.translate(c, "‘’“”", "''\"\"")


def name_normal(c: Column) -> Column:
    """Lowered, punctuation as spaces, leading rank words stripped."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "(?U)[^\\w\\s]", " "), "(?U)\\s+", " "))
    return F.regexp_replace(plain, f"^(?:(?:{'|'.join(RANKS)}) )+", "")


def name_variants(c: Column) -> Column:
    """Distinct normal forms: as given and without parentheses, and of both 'Last, First' turned round at the first comma."""
    bare = F.trim(F.regexp_replace(c, "\\s*\\([^)]*\\)", ""))
    turned = lambda x: F.when(x.contains(","), F.concat_ws(" ", F.trim(F.regexp_extract(x, "^([^,]*),(?s)(.*)$", 2)), F.trim(F.regexp_extract(x, "^([^,]*),(?s)(.*)$", 1))))
    return F.array_distinct(F.filter(F.array(name_normal(c), name_normal(bare), name_normal(turned(c)), name_normal(turned(bare))), lambda v: v.isNotNull() & (v != "")))


def proper_nouns(c: Column) -> Column:
    """Capitalised words but for sentence openers; duplicates kept."""
    return F.filter(F.regexp_extract_all(c, F.lit("\\b[A-Z][a-zA-Z]+"), F.lit(0)), lambda t: ~t.isin(OPENERS))


def canonical_type(c: Column) -> Column:
    """Plural node types to their singular."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv]), c), c)


def padded_contains(haystack: Column, needle: Column) -> Column:
    """Whole-word containment after normalisation of both."""
    flat = lambda x: F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered(x), "[^a-z0-9]+", " ")), F.lit(" "))
    return F.contains(flat(haystack), flat(needle))


def concept_match(text: Column, terms: Column) -> Column:
    """Every OR-group of ``terms`` (array<array<string>>) has a hit."""
    return F.forall(terms, lambda group: F.exists(group, lambda t: padded_contains(text, t)))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")


# Fixed value: a speaker's label before a quotation.
SPEAKER = "^[A-Z][A-Za-z.'-]+(?: [A-Z][A-Za-z.'-]+){0,3}:\\s+"


def strip_speaker(c: Column) -> Column:
    """'Name: words' to 'words'."""
    return F.regexp_replace(c, SPEAKER, "")


def display_context(body: Column, start: Column, end: Column, around: int = 240) -> Column:
    """The span with some characters round it, annotations removed."""
    begin = F.greatest(F.lit(0), start - around)
    cut = body.substr((begin + 1).cast("int"), (F.least(F.length(body), end + around) - begin).cast("int"))
    return collapsed(F.regexp_replace(cut, "\\{\\{[^}]*\\}\\}|<!--.*?-->", " "))
