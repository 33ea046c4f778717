"""Decontamination, enrichment and clustering against brute force, and what the stages do with odd columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from siglane.llm import components as components_of
from siglane.llm import centroids, decontamination, enrichment, exact, mixing, neardup, queries, toxicity
from tests.conftest import SF


def said(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


ITEMS = [
    (1, "What is the capital of France, and which river runs through its old town?"), (2, "of France and which river runs through its old town today"), (3, "Short one"), (4, ""), (5, None),
    (6, "ÄRGER über 42 Straßen: a b c d e f g h"), (None, "no id for these ten words of the item at all"), (1, "second text of item one has more than ten words in it"), (8, "so it goes " * 8), (9, "?!"),
]
TEXTS = [
    None, "", "...", "one", "SHORT... one", "short two one", "we ask: what is the CAPITAL of France - and which river runs through its old town? Nobody knows. short  one!", "ärger Über", "xx ÄRGER über 42 Straßen: a b c d e f g h yy", "so it goes " * 20,
    "no id for these ten words of the item at all", "no id for these ten words of the item at", "word " * 30_000 + "short one" + " word" * 100, "a" * 100_000, "second text of item one has more than ten words in", "shortone short_one short\x00one 日本語 short one 😀",
]


def expected(text, items, size=10):
    own, hit, met = said(text), set(), set()
    for i, t in items:
        w = said(t)
        n = min(size, len(w))
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        for k in range(len(own) - n + 1 if n else 0):
            if tuple(own[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                met.add("" if i is None else str(i))
    return len(own), len(hit), sorted(met)


@pytest.mark.parametrize("block", [decontamination.BLOCK, 25])
def test_op11_is_brute_force(spark, block):
    docs = spark.createDataFrame([(k, t, {"a": k}, "x") for k, t in enumerate([*TEXTS, TEXTS[6]])], "doc_id long, text string, `n.words` map<string,long>, spans string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = {r.doc_id: r for r in decontamination.report(docs, items, block=block).collect()}
    full = decontamination.contaminated(docs, items, block=block)
    assert full.columns == ["doc_id", "text", "n.words", "spans", "n_words", "spans_", "items"]
    whole = {r[0]: r for r in full.collect()}
    for k, t in enumerate([*TEXTS, TEXTS[6]]):
        n, hit, met = expected(t, ITEMS)
        r = rows[k]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(met), hashlib.sha256(",".join(met).encode()).hexdigest(), hit > 0), t
        for s in whole[k].spans_:
            cut = t[s["start"] : s["stop"]]
            assert said(cut) == said(t)[s["first"] : s["last"] + 1] and cut == cut.strip(" .,?!-:")
        assert whole[k][2] == {"a": k} and whole[k].spans == "x" and list(whole[k]["items"]) == met
    kept = decontamination.decontaminate(docs, items)
    assert kept.columns == docs.columns and {r[0] for r in kept.collect()} == {k for k, r in rows.items() if not r.contaminated}
    assert decontamination.report(docs.limit(0), items).count() == 0
    assert decontamination.report(docs, items.limit(0)).filter("contaminated").count() == 0


def test_op11_of_many_overlapping_windows(spark):
    gen = random.Random(3)
    word = lambda: gen.choice("a b c d e".split())
    items = [(k, " ".join(word() for _ in range(gen.choice([1, 2, 3, 5, 12])))) for k in range(12)]
    texts = [" ".join(word() for _ in range(gen.randint(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), window=3, block=9).collect()}
    for k, t in enumerate(texts):
        n, hit, met = expected(t, items, 3)
        assert (got[k].n_words, sum(s["last"] - s["first"] + 1 for s in got[k].spans), list(got[k]["items"])) == (n, hit, met)


def simulated(sales, changes, plan):
    """The batches one after the other, in plain Python."""
    day = lambda t: (t - datetime(1970, 1, 1)).days
    number = lambda d: max(0, min(plan.batches - 1, (d - plan.first_day) * plan.batches // plan.days))
    of_sales, of_changes = {}, {}
    for s in sales:
        of_sales.setdefault(plan.batches - 1 if s[3] is None else number(day(s[3])), []).append(s)
    for c in set(changes):
        if c[4] is not None:
            of_changes.setdefault(number(day(c[4]) + zlib.crc32(str(c[0]).encode()) % 4), []).append(c)
    held, waiting, out = {}, [], []
    tops = [None, None]
    order = lambda c: (c[4], c[0])
    cents = lambda c: None if c[8] is None else int(Decimal(c[8] * 100 + 0.5).to_integral_value("ROUND_FLOOR"))
    for b in range(plan.batches + 1):
        marks = [None if t is None else t - timedelta(microseconds=plan.lag_micros) for t in tops]
        h = None if None in marks else min(marks)
        for c in of_changes.get(b, []):
            if marks[1] is not None and c[4] < marks[1]:
                out.append(("late", c[0], b, None, None, None, None))
            elif c[1] is not None:
                held.setdefault(c[1], []).append(c)
        now = waiting + of_sales.get(b, [])
        waiting = []
        for s in now:
            if b < plan.batches and s[2] is not None and (h is None or s[2] >= h):
                waiting.append(s)
                continue
            own = held.get(s[1], [])
            fits = sorted((c for c in own if s[2] is not None and c[4] <= s[2]), key=order)
            out.append(("sale", s[0], b, len(own), *((fits[-1][0], cents(fits[-1]), fits[-1][3]) if fits else (None, None, None))))
        if h is not None:
            for k, own in held.items():
                old = sorted((c for c in own if c[4] <= h), key=order)
                held[k] = old[-1:] + [c for c in own if c[4] > h]
        for k, rows, at in ((0, of_sales.get(b, []), 2), (1, of_changes.get(b, []), 4)):
            tops[k] = max([t for t in (tops[k], *(r[at] for r in rows)) if t is not None], default=None)
    return Counter(out)


def test_op12_is_the_simulation(spark, monkeypatch):
    gen, start = random.Random(5), datetime(2024, 1, 1)
    plan = enrichment.Plan(batches=4, days=40)
    monkeypatch.setattr(enrichment, "HOT_SHARE", 8)
    monkeypatch.setattr(enrichment, "SLICES", 5)

    def at(days=40):
        return start + timedelta(seconds=gen.choice([gen.randint(0, days * 86400), gen.randint(0, days) * 86400]))

    client = lambda: gen.choice([7] * 6 + [None, 1, 2, 3, 4, 5, 6, 8, 9])
    sales = [(k, client(), gen.choice([at(), at(), at(), None]) if k % 9 == 0 else (t := at()), (t if k % 9 else at()) + timedelta(days=gen.choice([0, 0, 0, 1, 9]))) for k in range(1500)]
    sales += [sales[3], sales[4], (9001, 7, start, None), (9002, 7, datetime(2023, 5, 5), datetime(2023, 5, 5)), (9003, 7, datetime(2025, 5, 5), datetime(2024, 2, 2))]
    # Many versions at equal times, some of them at a horizon.
    changes = [(k, client() if k % 40 else None, k % 5, gen.choice("IUD"), None if k % 31 == 0 else at(38), "s", None, "c", gen.choice([None, 1.005, -2.675, round(gen.uniform(-999, 9999), 2)])) for k in range(900)]
    changes += changes[:50]
    s = spark.createDataFrame([(*r, "x") for r in sales], "sale_id long, client_id long, sold_at timestamp_ntz, arrived_at timestamp_ntz, client string")
    c = spark.createDataFrame([(*r, {"k": 1}) for r in changes], "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double, kind map<string,int>")
    rows = Counter(tuple(r) for r in enrichment.enrich(s, c, plan).collect())
    assert rows == simulated(sales, changes, plan)
    assert sum(1 for r in rows if r[0] == "late") > 5 and sum(1 for r in rows if r[0] == "sale" and r[4] is None and r[3]) > 5


def test_op12_of_one_empty_table(spark):
    plan = enrichment.Plan(batches=1, days=40)
    s = spark.createDataFrame([(1, 7, datetime(2024, 1, 2), datetime(2024, 1, 2)), (2, None, None, None)], "sale_id long, client_id long, sold_at timestamp_ntz, arrived_at timestamp_ntz")
    c = spark.createDataFrame([], "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double")
    assert {tuple(r) for r in enrichment.enrich(s, c, plan).collect()} == {("sale", 1, 1, 0, None, None, None), ("sale", 2, 0, 0, None, None, None)}


def test_op12_opens_no_native_stores_and_is_its_sql(spark):
    """Each start opens a store in every partition; a RocksDB store leaves native memory of the executor behind."""
    started = []

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            started.extend((event.progress.runId, dict(o.customMetrics), o.numRowsUpdated) for o in event.progress.stateOperators)

        def onQueryTerminated(self, event):
            pass

    listener = Listener()
    spark.streams.addListener(listener)
    before = {k: spark.conf.get(k, None) for k in enrichment.SETTINGS}
    try:
        rows = Counter(tuple(r) for r in queries.QUERIES["op12_valid_time_sales"](spark, SF).collect())
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    assert {k: spark.conf.get(k, None) for k in enrichment.SETTINGS} == before
    assert len({x[0] for x in started}) == 11 and any(x[2] for x in started)
    assert not [k for x in started for k in x[1] if "rocksdb" in k.lower()]
    con = duckdb.connect()
    for t in ("sales", "client_changes"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert rows == Counter(con.sql(queries.ORACLES["op12_valid_time_sales"]).fetchall())


def plainly(vectors, clusters, rounds):
    whole = [(i, [int(np.floor(256 * np.float64(x))) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    by = sorted(whole, key=lambda x: (hashlib.sha256(f"2:{'' if x[0] is None else x[0]}".encode()).hexdigest(),))
    cs = [v for _, v in by[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(cs))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in whole]
        for k in range(len(cs)):
            own = [v for (_, v), o in zip(whole, of, strict=True) if o == k]
            cs[k] = [sum(x) // len(own) for x in zip(*own, strict=True)] if own else cs[k]
    got = [(i, *near(v)) for i, v in whole]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return Counter((i, k, d, sum(x[1] for x in got if x[2] == k), sum(x[1] for x in got), digests[k]) for i, d, k in got)


def test_op13_is_brute_force(spark):
    gen = np.random.default_rng(1)
    # Coarse values and copies, so that many distances tie.
    vectors = [(k, [float(x) for x in np.float32(gen.integers(-2, 3, 64) / 256 if k % 3 else gen.normal(0, 0.3, 64))]) for k in range(220)]
    vectors += [(500 + k, vectors[5][1]) for k in range(30)]
    vectors += [(600, None), (601, []), (602, [1.0] * 63), (603, [1.0] * 63 + [None]), (604, [1.0] * 63 + [float("nan")]), (605, [float("inf")] + [1.0] * 63), (606, [-1e6 / 256] * 64), (None, [0.5] * 64)]
    df = spark.createDataFrame([(i, v, i, "x") for i, v in vectors], "vec_id long, embedding array<float>, v long, cluster string")
    for clusters in (40, 300):
        assert Counter(tuple(r) for r in centroids.clustered(df, clusters, 3).collect()) == plainly(vectors, clusters, 3)
    assert centroids.clustered(df.limit(0)).count() == 0


def test_partial_distances_find_the_smaller_number_of_ties():
    x = np.array([[0] * 64, [5] * 64])
    c = np.array([[1] * 64, [-1] * 64, [1] * 64, [9] * 64])
    number, best = centroids.nearest(x, c, np.arange(63, -1, -1))
    assert number.tolist() == [0, 0] and best.tolist() == [64, 64 * 16]


def test_stages_keep_every_row_as_it_is(spark):
    """Maps, arrays with nulls, names with dots and backquotes, names that are there twice."""
    texts = ["alpha beta gamma delta epsilon", "alpha beta gamma delta  epsilon", "other words of some other text", "lone"]
    tags, maps = [[None, "a"], ["a"], ["a", None], None, []], [{"k": "x"}, {"k": "y"}, {}, None, {"k": None}]
    rows = [(k % 4, texts[k % 4], "s", tags[k % 5], maps[k // 5 % 5], k) for k in range(25)] + [(0, texts[0], "s", [None, "a"], {"k": "x"}, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` array<string>, `c``d` map<string,string>, n int").toDF("doc_id", "text", "source", "a.b", "c`d", "text_")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int")
    mark = lambda r: repr(tuple(r))
    given = Counter(mark(r) for r in docs.collect())
    for work in (lambda d: mixing.mixed_documents(d), lambda d: toxicity.drop_toxic(d, labels), exact.drop_exact_duplicates, neardup.drop_near_duplicates):
        out = work(docs)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert {mark(r) for r in out.collect()} <= set(given)
    mixed = Counter(mark(r) for r in mixing.mixed_documents(docs).collect())
    assert mixed == given  # one source: its target is its size, so every row once
    twice = docs.toDF("doc_id", "text", "source", "x", "y", "x")
    assert exact.drop_exact_duplicates(twice).columns == twice.columns and exact.drop_exact_duplicates(twice).count() == 3


def test_op7_fits_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(k % 3, f"text {k}") for k in range(2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(3)], "doc_id long, toxic int")
    seen = []
    original = toxicity.train
    toxicity.train = lambda texts, *rest: seen.append(len(texts)) or original(texts, *rest)
    try:
        toxicity.score_toxicity(docs, labels).agg(F.count("*")).collect()
    finally:
        toxicity.train = original
    assert seen and seen[0] <= 3


@pytest.mark.parametrize("together", [-1, 40, 1 << 18])
def test_components_by_rounds_and_in_one_task(spark, monkeypatch, together):
    monkeypatch.setattr(components_of, "TOGETHER", together)
    gen = random.Random(2)
    name = lambda k: k.to_bytes(4, "big")
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(gen.randrange(200, 260), gen.randrange(200, 260)) for _ in range(40)] + [(5, 6)] * 9
    found = {bytes(r.node): bytes(r.component) for r in components_of.components(spark.createDataFrame([(name(a), name(b)) for a, b in edges], "a binary, b binary").repartition(6)).collect()}
    least = {k: k for e in edges for k in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert {k: name(v) for k, v in ((name(k), v) for k, v in least.items() if sum(1 for x in least.values() if x == v) > 1)} == {k: v for k, v in found.items()}
