"""Odd values and plans that show only in larger tables."""

from oracle import same

from folioscope.operators import align, batches, chunks, evaluation, grade, sequences, spans
from folioscope.plans import catalogue, evidence  # noqa: F401 - registers its queries
from folioscope.streaming import stopping


def test_heads_with_commas_and_brackets_count_as_they_are(spark, tmp_path):
    # turn 3: "lake," stands beyond the 60th character, "lake" within; turn 1: the head is "(sic)"
    far = "the lake shore " + "x" * 60
    rows = [(1, 3, "user", "the lake " + "x" * 60 + " lake, too"), (2, 1, "user", "a (sic) b"), (3, 1, "assistant", "a lake, b"), (4, 2, "user", far), (5, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/rows")
    next((tmp_path / "rows").glob("*.parquet")).rename(tmp_path / "conversations.parquet")
    same(catalogue.QUERIES["q59_subject_first"](spark, str(tmp_path)), catalogue.ORACLES["q59_subject_first"], str(tmp_path))


def test_words_of_stretches_are_never_broadcast(spark, tmp_path, monkeypatch):
    """A small table of long stretches stands for all words of the streams."""

    def saved(df):
        path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    monkeypatch.setattr(sequences, "saved", saved)
    words = spark.range(200).selectExpr("'k' AS k", "cast(id AS int) AS pos", "concat('w', id) AS word")
    got = sequences.matched_words(words, words.where("pos <> 50"), "k")
    assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
    assert got.count() == 199


def test_account_texts_are_compared_once(spark):
    """No pair of accounts compares texts of its own; the join of accounts comes after."""
    shape = "k int, account_id int, title string, subject string, l0 int, l1 int"
    g = spark.createDataFrame([(1, i, "the red house", None, 1, 5) for i in range(4)], shape)
    p = spark.createDataFrame([(1, i, "a red barn", "", None, None) for i in range(3)] + [(1, 9, None, "house", 9, 9)], shape)
    out = evaluation.account_candidates(g, p, "k")
    assert {(r.predicted, r.semantic_score, r.eligible) for r in out.collect()} == {(0, 0.5, True), (1, 0.5, True), (2, 0.5, True), (9, 0.0, False)} and out.count() == 16
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan[: plan.index("RepartitionByExpression")]


def test_maps_over_texts_hold_pieces():
    import pyarrow as pa

    texts = ["a" * 40, None, "b" * 200, "", *["c" * 30] * 5]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    got = list(batches.pieces(b, 1, 100))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([b])) and [p.num_rows for p in got] == [2, 1, 4, 2]
    assert list(batches.pieces(b.slice(0, 0), 1)) == []


def test_word_and_chunk_maps_over_odd_texts(spark):
    docs = spark.createDataFrame([(1, "ab cd\nef"), (2, None), (3, "")], "k int, t string")
    assert sorted(map(tuple, spans.word_offsets(docs, "k", "t").collect())) == [(1, 0, "ab", 0), (1, 1, "cd", 3), (1, 2, "ef", 6)]
    assert sorted(map(tuple, chunks.chunk_rows(docs, "k", "t", 150_000).collect())) == [(1, 0, 0, 8, "ab cd\nef"), (2, 0, 0, 0, ""), (3, 0, 0, 0, "")]


def test_the_stop_rule_reads_and_writes_its_state_once():
    """Each call of the state is a round trip, so their number does not grow with a record's rounds."""
    import pandas as pd

    calls = []

    class State:
        def __init__(self):
            self.rows = []

        def get(self):
            calls.append("get")
            return iter(self.rows)

        def appendList(self, rows):
            calls.append("append")
            self.rows = self.rows + rows

        def put(self, rows):
            calls.append("put")
            self.rows = rows

    class Handle:
        def getListState(self, name, schema):
            return State()

    rule = stopping.StopRule(1)
    rule.init(Handle())
    rounds = lambda a, b: pd.DataFrame([(0, i, [{"pos": 0, "identity": f"x{i // 2}"}, {"pos": 1, "identity": f"y{i}"}], False) for i in range(a, b)], columns=["chunk", "round", "items", "complete"])
    first, second = (pd.concat(rule.handleInputRows(("k",), iter([rounds(a, b)]), None)) for a, b in ((0, 2), (2, 3)))
    assert first["identity"].tolist() == ["x0", "y0", "y1"] and second["identity"].tolist() == ["x1", "y2"] and len(calls) == 8


def test_records_are_searched_by_the_batch(spark):
    """No task or group for each record: the plans of grading and of relocation have maps alone. Null keys meet null keys, keys without a text are broken."""
    texts = spark.createDataFrame([("a", "One two THREE four"), (None, "five six"), ("c", "ΣΑΣ straße İx end")], "record_key string, body string")
    asked = spark.createDataFrame([("a", 1, "two three"), (None, 2, "six"), ("b", 3, "two"), ("c", 4, "straße"), ("c", 5, None)], "record_key string, n int, quote string")
    got = grade.located_claims(asked, texts)
    assert "CoGroup" not in got._jdf.queryExecution().sparkPlan().toString()
    assert {r.n: (r.status, [tuple(x) for x in r.spans]) for r in got.collect()} == {1: ("contiguous", [(4, 13)]), 2: ("contiguous", [(5, 8)]), 3: ("broken", []), 4: ("contiguous", [(4, 10)]), 5: ("broken", [])}
    words = texts.selectExpr("record_key", "posexplode(split(lower(body), ' ')) AS (pos, word)").selectExpr("*", "pos * 2 AS at")
    moved = align.relocated(asked.selectExpr("record_key", "n", "quote", "'p' AS location"), words, False)
    assert "CoGroup" not in moved._jdf.queryExecution().sparkPlan().toString()
    assert {r.n: (r.location, r.state) for r in moved.collect()} == {1: ("char:2-4", "aligned"), 2: ("char:2-2", "aligned"), 3: ("p", "unaligned"), 4: ("p", "unaligned"), 5: ("p", "unaligned")}


def test_accounts_are_dealt_out_once_and_pairs_never(spark, monkeypatch):
    """Whatever the predicted accounts' number, a gold account's row is shuffled once: each part of them is a narrow pass, and the parts make up the whole."""
    shape = "k int, account_id int, title string, subject string, l0 int, l1 int"
    g = spark.createDataFrame([(k, i, f"the red house {i % 3}", "x", i, i + 4) for k in (1, 2, None) for i in range(30)], shape)
    p = spark.createDataFrame([(k, i, f"a red barn {i % 4}", None, i + 2, i + 5) for k in (1, 2, None) for i in range(20)], shape)
    rows = lambda: sorted(map(tuple, evaluation.account_candidates(g, p, "k").collect()))
    whole = rows()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = evaluation.account_candidates(g, p, "k")._jdf.queryExecution().sparkPlan().toString()
        top = plan[: plan.index("RepartitionByExpression" if "RepartitionByExpression" in plan else "Exchange")]
        assert "SortMergeJoin" not in top and plan.count("BroadcastHashJoin") >= 2
        monkeypatch.setattr(evaluation, "SENT", 500)
        assert rows() == whole and len(whole) == 2 * 30 * 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_claims_beside_their_text_are_relocated_where_they_stand(spark):
    """No exchange; the places are those of claims and words in rows of their own. Keys may repeat; texts and claims may be missing."""
    texts = [("a", "One two, THREE four five six"), ("b", "ΣΑΣ straße İx end of it all"), ("c", None), (None, "one two three")]
    asked = {"a": ["two three four", "no such words here"], "b": ["end of it", None], "c": ["two three"], None: None}
    rows = [(k, t, asked[k] and [(k, i, q, "p") for i, q in enumerate(asked[k])]) for k, t in texts]
    shape = "record_key string, body string, claims array<struct<record_key:string,n:int,quote:string,location:string>>"
    records = spark.createDataFrame(rows + rows[:1], shape)
    got = align.relocated_in(records, "claims", body="body")
    assert "Exchange" not in got._jdf.queryExecution().sparkPlan().toString()
    one = spark.createDataFrame(rows, shape)
    plain = align.relocated(one.selectExpr("inline(claims)"), spans.word_offsets(one, "record_key", "body"), False)
    key = lambda r: (r.record_key, r.n, r.quote, r.location, r.state)
    assert sorted(map(key, got.collect()), key=str) == sorted([*map(key, plain.collect()), *(key(r) for r in plain.where("record_key = 'a'").collect())], key=str)
    timed = align.relocated_in(records.selectExpr("claims", "split(lower(body), '[^a-z0-9]+') AS ws"), "claims", words="ws", step=1.5)
    assert {(r.record_key, r.n, r.location, r.state) for r in timed.collect() if r.record_key == "a"} == {("a", 0, "00:00:01.5-00:00:04.5", "aligned"), ("a", 1, "p", "unaligned")}


def test_relocation_of_documents_shuffles_nothing(spark, small):
    plan = catalogue.QUERIES["q86_relocated"](spark, small)._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_digests_of_one_row_are_graded_where_they_stand(spark):
    """The figures of ``grade``, without an exchange: overlapping, repeated, elided, reordered, empty and missing quotes, lost units, missing texts."""
    import random

    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    cut = lambda: " ".join(words[(a := rng.randint(0, 50)) : a + rng.randint(1, 12)])
    quote = lambda: rng.choice([cut(), cut(), f"{cut()} ... {cut()}", "nowhere", "", None, " W3  w4.", "w5"])
    unit = lambda: rng.choice([[cut()], [cut(), cut()], ["gone"], [], None])
    bodies = [" ".join(words), "# head\n" + "\n".join(words), "00:00:01.5 " + "  ".join(words), None, ""]
    rows = [(f"d{k}", rng.choice(bodies[:3] * 3 + bodies[3:]), [(f"u{i}", unit()) for i in range(rng.randint(0, 4))], [(f"c{i}", quote()) for i in range(rng.randint(0, 6))]) for k in range(60)]
    shape = "digest_key string, body string, gold array<struct<unit_id:string,parts:array<string>>>, claims array<struct<claim_id:string,quote:string>>"
    df = spark.createDataFrame(rows, shape)
    mine = grade.grade_in(df)
    assert "Exchange" not in mine._jdf.queryExecution().sparkPlan().toString()
    records = df.selectExpr("digest_key AS record_key", "body")
    whole = grade.grade(records, df.selectExpr("digest_key AS record_key", "inline(gold)"), df.selectExpr("digest_key", "digest_key AS record_key", "inline(claims)"))
    seen = lambda d: {r.digest_key: tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.select(mine.columns).collect()}
    got, wanted = seen(mine), seen(whole)
    assert got == wanted and len(got) == sum(bool(r[3]) for r in rows)


def test_even_texts_are_mapped_as_others():
    for text in ("a B c", "a b ", " a", "a  b", "# a", " # a", "a #b", "a\tb", "<!-- x -->", "00:00:01.5 a b", "É a", ""):
        search, at = grade.search_map(text)
        long, places = grade.search_map(text + "\né")  # a second line takes the slow way
        assert long.startswith(search.rstrip()) and list(at)[: len(search.rstrip())] == list(places)[: len(search.rstrip())] and len(at) == len(search)
