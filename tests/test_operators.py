import random
from itertools import permutations

from pyspark.sql import functions as F

from folioscope.functions import codes
from folioscope.functions import text as T
from folioscope.operators import accounts, chunks, dedup, evaluation, extract, grade, graph, health, joins, permutation, salience, spans, validation
from folioscope.operators.align import align


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


def test_union_coverage_against_sets(spark):
    rng = random.Random(5)
    spans_ = [(k, *sorted(rng.sample(range(60), 2))) for k in "ab" for _ in range(12)]
    gold = [(k, g, *sorted(rng.sample(range(60), 2))) for k in "ab" for g in range(6)]
    got = spans.union_coverage(spark.createDataFrame(gold, "k string, g int, start long, end long"), spark.createDataFrame(spans_, "k string, start long, end long"), ["k"], "g")
    expected = {(k, g): len({x for x in range(s, e)} & {x for q, a, b in spans_ if q == k for x in range(a, b)}) for k, g, s, e in gold}
    assert {(r.k, r.g): r.covered for r in got.collect()} == expected


def test_containers(spark):
    points = spark.createDataFrame([("r", "p1", 5), ("r", "p2", 10), ("r", "p3", 99)], "k string, p string, at int")
    boxes = spark.createDataFrame([("r", 1, 0, 10), ("r", 2, 4, 6), ("r", 3, 10, 12), ("r", 4, 5, 7)], "k string, s int, start int, end int")
    assert {r.p: r.bound for r in spans.smallest_container(points, boxes, ["k"], "p", "at", "s", ["s"]).collect()} == {"p1": 2, "p2": 3, "p3": None}
    assert {r.p: r.bound for r in spans.exact_container(points, boxes, ["k"], "p", "at", "s").collect()} == {"p1": None, "p2": 3, "p3": None}


def test_quote_status(spark):
    rows = [("contiguous", "b c"), ("elided", "a b ... d"), ("reordered", "d … a b"), ("broken", "a ... z"), ("broken", " ... ")]
    df = spark.createDataFrame([("a b c d", q, e) for e, q in rows], "t string, q string, e string")
    assert [r.s for r in df.select("e", spans.quote_status(F.col("t"), F.col("q")).alias("s")).collect()] == [e for e, _ in rows]


def test_locate_counts_code_points_and_retries(spark):
    assert one(spark, spans.locate(F.col("t"), F.col("q")), t="😀éab.", q="ab!") == 2


def test_greedy_and_neighbours(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 3, 8), ("a", 5, 7), ("a", 20, 30)], "k string, start long, end long")
    assert sorted((r.start, r.end) for r in spans.drop_overlapping(df, ["k"]).collect()) == [(0, 5), (5, 7), (20, 30)]
    assert {(r.start, r.end) for r in spans.neighbour_overlaps(df, ["k"]).collect()} == {(3, 8), (5, 7)}


def test_iou(spark):
    a = spark.createDataFrame([(1, 0, 10)], "k int, start int, end int")
    b = spark.createDataFrame([(1, 5, 10), (1, 20, 25)], "k int, start int, end int")
    assert spans.multipart_iou(a, b, ["k"]).first().iou == 5 / 15


def test_chapters_and_words(spark):
    d = spark.createDataFrame([(1, "x<!-- chapter: A -->one two<!-- chapter: B -->three")], "k int, body string")
    assert [(r.label, r.start, r.end) for r in spans.chapter_spans(d, "k", "body").orderBy("start").collect()] == [("A", 20, 27), ("B", 46, 51)]
    t = spark.createDataFrame([(1, "{{t:1.5}}Hello {{t:2.0}}big world"), (2, "none")], "k int, body string")
    assert [(r.word, r.at) for r in spans.timed_words(t, "k", "body").orderBy("pos").collect()] == [("hello", 1.5), ("big", 2.0), ("world", 2.0)]
    line = spark.createDataFrame([(1, "00:00:07.5 Well then\nno stamp")], "k int, body string")
    assert [(r.word, r.at) for r in spans.line_words(line, "k", "body").orderBy("pos").collect()] == [("well", 7.5), ("then", 7.5)]


def test_nearest_forward_clamps(spark):
    p = spark.createDataFrame([(1, 5), (1, 50), (2, 1)], "k int, t int")
    a = spark.createDataFrame([(1, 5, "x"), (1, 9, "y")], "k int, at int, v string")
    assert {(r.k, r.t): r.v for r in joins.nearest_forward(p, a, ["k"], "t", "at", "v").collect()} == {(1, 5): "x", (1, 50): "y", (2, 1): None}


def test_names(spark):
    assert one(spark, T.name_variants(F.col("n")), n="Dr. Smith, John (Jack)")[0] == "smith john jack"
    assert one(spark, T.name_normal(F.col("n")), n="Prof. Sir O'Neil-Ray") == "o neil ray"
    assert one(spark, T.content_tokens(F.col("n")), n="The pilot's reports reports of the") == ["pilot", "report"]
    assert one(spark, T.padded_contains(F.col("a"), F.col("b")), a="a near-miss, then", b="miss then")
    assert one(spark, T.canonical_type(F.col("n")), n="people") == "person"


def test_first_wins_and_replay(spark):
    rows = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 1, "only")], "k string, o int, v string")
    assert {r.v for r in dedup.first_wins(rows, ["k"], ["o"]).collect()} == {"first", "only"}
    items = [("r", 0, 0, i, f"n{i}", False) for i in range(3)] + [("r", 0, 1, 0, "n0", False), ("r", 0, 1, 1, "x", False), ("r", 0, 2, 0, "never", False)]
    items += [("r", 1, 0, 0, "never", False), ("r", 1, 0, 1, "n1", True)]
    df = spark.createDataFrame(items, "record_key string, chunk int, round int, pos int, identity string, complete boolean")
    got = {(r.chunk, r.round, r.identity) for r in dedup.replay_rounds(df).collect()}
    assert got == {(0, 0, "n0"), (0, 0, "n1"), (0, 0, "n2"), (0, 1, "x"), (1, 0, "never")}
    c = spark.createDataFrame([("r", 0, "t")], "record_key string, idx int, text string")
    assert {r.chunk for r in extract.run(c, extract.Canned(df)).collect()} == {0}


def test_closure_with_cycles(spark):
    e = spark.createDataFrame([("g", 1, 2), ("g", 2, 3), ("g", 3, 1), ("g", 3, 4), ("g", 5, 99)], "k string, dependent int, ancestor int")
    ids = spark.createDataFrame([("g", i) for i in range(1, 6)], "k string, id int")
    got = {(r.dependent, r.ancestor) for r in graph.ancestors(e, ids, ["k"]).collect()}
    assert got == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4) if a != b}
    loops = graph.cycles(e.select("k", F.col("dependent").alias("before"), F.col("ancestor").alias("after")), ["k"])
    assert {r.id for r in loops.collect()} == {1, 2, 3}


def test_parents(spark):
    n = spark.createDataFrame([("k", 1, None, 0, 100), ("k", 2, 1, 10, 20), ("k", 3, 2, 15, 30), ("k", 4, 9, 0, 1)], "k string, id int, parent int, start int, end int")
    assert {(r.id, r.problem) for r in graph.parent_violations(n, ["k"]).collect()} == {(3, "outside its parent"), (4, "missing parent")}


def test_chunks_reassemble():
    rng = random.Random(1)
    for _ in range(40):
        text = "".join(rng.choice(["word ", "\n", "\n\n", "## h\n", "<!-- chapter: x -->", "\n<!-- chapter: y -->\n"]) for _ in range(rng.randint(0, 300)))
        for spans_ in (chunks.windows(text, 200, 50), chunks.build(text, 100)):
            assert "".join(text[s:e] for s, e in spans_) == text
        assert all(e - s <= 200 for s, e in chunks.windows(text, 200, 50))


def test_align():
    body = "He walked slowly home. Then, quite suddenly, the light went out over the harbour and nobody spoke."
    s, e, c, state = align(body, "Ann: the light went out over the harbor and nobody spoke")
    assert body[s:e].startswith("the light") and body[s:e].endswith("spoke") and c > 0.8 and state == "aligned"
    assert align(body, "completely different words here") is None
    assert align("go on now then. " * 3, "go on now then")[3] in ("aligned", "ambiguous")
    assert align("", "x") is None


def test_codes(spark):
    assert one(spark, codes.timecode(F.col("s")), s=3725.25) == "01:02:05.2"
    assert one(spark, codes.timecode(F.col("s")), s=-3.0) == "00:00:00.0"
    assert one(spark, codes.parse_timecode(F.col("s")), s="01:02:05.5") == 3725.5
    assert one(spark, codes.parse_timecode(F.col("s")), s="1:2:5") is None
    assert one(spark, codes.claim_position(F.col("s")), s="ch3b:10-20").asDict() == {"axis": "chapter", "label": "3b", "start": 10.0, "end": 20.0}
    assert one(spark, codes.milliseconds(F.col("s")), s="1.2345") is None and one(spark, codes.milliseconds(F.col("s")), s="1.234") == 1234
    assert one(spark, codes.split_stem(F.col("s")), s="a.b.0123abcd.run.1").asDict() == {"head": "a.b", "prompt_sha8": "0123abcd", "run_label": "run.1"}
    assert one(spark, codes.split_stem(F.col("s")), s="plain.name").head == "plain.name"
    assert one(spark, codes.iso_date(F.col("s")), s="2020-01-02T00:00:00") == "2020-01-02"
    assert one(spark, codes.iso_date(F.col("s")), s="2020-01") == "2020-01"
    assert one(spark, codes.producer(F.col("s")), s=["", "{{x}}", "Ann"]) == "Ann"
    assert one(spark, codes.rights(F.col("s")), s="licensed").asDict() == {"hosted": False, "reason": "licensed"}
    assert one(spark, codes.generation_state(F.col("s"), F.lit(5)), s="3") == "stale:2"


def test_health(spark):
    rows = spark.createDataFrame([(f"d{i}", "video", "spoken", 1.0) for i in range(6)] + [("low", "video", "spoken", 0.1), ("odd", "pdf", "document", 9.0)], "id string, kind string, family string, rate double")
    assert [r.id for r in health.low_yield(rows, "kind", "family", "rate").collect()] == ["low"]
    assert permutation.permutation_p([3.0, 4.0], [1.0, 2.0]) == 1 / 6
    arms = spark.createDataFrame([("m", "a", 3.0), ("m", "a", 4.0), ("m", "b", 1.0)], "model string, arm string, value double")
    assert health.complete_separation(arms, "model").first().separated
    none = spark.createDataFrame([], "key string, detail string")
    assert [(r.check, r.status) for r in health.findings(empty=none).collect()] == [("empty", "nothing")]


def test_evaluation(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "w string, p int")
    assert [r.w for r in evaluation.division(rows, "w", "p", rows.select("p")).collect()] == ["a"]
    old = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 3.0)], "k string, value double")
    new = spark.createDataFrame([("x", 2.0), ("y", 2.0), ("w", 1.0)], "k string, value double")
    cmp = evaluation.compare_scores(old, new, "k")
    assert {r.k: r.outcome for r in cmp.collect()} == {"x": "better", "y": "unchanged", "z": "worse", "w": "better"}
    assert evaluation.overall_outcome(cmp).first().outcome == "mixed"
    flags = evaluation.regression_flags(spark.createDataFrame([(0.5, 1.0, 9.0, 1.0)], "recall double, precision double, cost double, seconds double"), 0.9, 0.9, 5, 5)
    assert flags.first().flags == ["recall", "cost"]


def test_accounts(spark):
    bodies = spark.createDataFrame([("r", "It began at dawn. We saw a light. Later we went home. The end came at noon.")], "record_key string, body string")
    acc = spark.createDataFrame([("r", "a1", "It began", None), ("r", "a2", "Later we", "at noon")], "record_key string, account_id string, span_start string, span_end string")
    got = {r.account_id: (r.part, r.start, r.end) for r in accounts.resolve_all(acc, bodies).collect()}
    assert got == {"a1": (0, 0, 34), "a2": (0, 34, 74)}
    claims = spark.createDataFrame([("r", "c1", "char:5-9"), ("r", "c2", "char:900-910"), ("r", "c3", "nowhere")], "record_key string, claim_id string, location string")
    sp = spark.createDataFrame([("r", "a1", 0.0, 34.0)], "record_key string, account_id string, start double, end double")
    assert {r.claim_id: r.state for r in accounts.bind(claims, sp).collect()} == {"c1": "bound", "c2": "outside", "c3": "unbindable"}
    assert accounts.offset_for_time([(1.0, 10), (5.0, 50)], 3.0) == 50 and accounts.offset_for_time([(1.0, 10)], 9.0) == 10


def test_grade(spark):
    rec = spark.createDataFrame([("r", "The cat sat. The dog ran away. Birds sang.")], "record_key string, body string")
    gold = spark.createDataFrame([("r", "u1", "The cat sat."), ("r", "u2", "Birds sang.")], "record_key string, unit_id string, text string")
    claims = spark.createDataFrame([("d", "r", "c1", "the CAT sat"), ("d", "r", "c2", "dog ran"), ("d", "r", "c3", "no such")], "digest_key string, record_key string, claim_id string, quote string")
    g = grade.grade(rec, gold, claims).first()
    assert g.fully_covered == 1 and abs(g.recall - 11 / 12 / 2) < 1e-9 and abs(g.fidelity - 2 / 3) < 1e-9 and g.off_target == 1


def test_validation(spark):
    units = spark.createDataFrame([("r", "u1", 0, 5, 10, "accept"), ("r", "u2", 4, 20, 10, "maybe")], "record_key string, unit_id string, start int, end int, n_chars int, decision string").withColumn("facts", F.array().cast("array<string>"))
    assert {(r.key, r.rule) for r in validation.gold_units(units).collect()} == {("u2", "span"), ("u2", "decision"), ("u2", "overlap")}
    try:
        validation.require(validation.unique_ids(units.withColumn("k", F.lit(1)), ["k"]))
        raise AssertionError("duplicates must be refused")
    except ValueError:
        pass


def test_salience_report(spark):
    claims = spark.createDataFrame([("d", "c1", "Ann Lee saw it.", [("1", "Ann Lee (pilot)", "mentioned")]), ("d", "c2", "Nothing.", [])], "digest_key string, claim_id string, text string, refs array<struct<id:string,name:string,role:string>>")
    got = {(r.check, r.key): r.value for r in salience.report(claims, spark.createDataFrame([("Ann Lee (pilot)",)], "name string")).collect()}
    assert got["sole_reference", "wrong_rate"] == 1.0 and got["subject_first", "rate"] == 0.0 and got["role_mix", "*"] == 1.0
