import hashlib
import math
import pickle
import random
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from siglane.llm import chat, exact, lm, media, mixing, neardup, pieces, queries, sharding, tokens, toxicity
from siglane.llm.common import HOT_SHARE, utf8, words
from siglane.llm.components import components
from tests.conftest import SF

SPACE = "[\x20\x09-\x0d]"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, digest string, rep string, class string, key string"
LONG = " ".join(f"w{k % 977}x" for k in range(30_000))
ODD = [None, "", " \n\t", "one", "two words", "  a  b\x0b c\r\n", "ﬁ Å 日本語 😀", "<|im_end|><s> <0x41> ▁▁ a▁b \\<|x", LONG, LONG + " end", "a" * 5000, "\x00 nul", "same text here now ok", "same text here now ok", "SAME text here  now ok"]


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t)


def split(t):
    return re.findall(r"[^\x20\x09-\x0d]+", lower(t or ""))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns with names that operators use."""
    rows = [(k, t, None if k % 2 else "en", None if k % 5 == 4 else "s" + str(k % 3), None, None, "d", None, "c", None) for k, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[3], rows[12], (None, "no id", None, None, None, 1, None, None, None, None), (None, None, None, None, None, 1, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2 == 0, int(k % 3 == 0)) for k in range(12)] + [(None, None, 1), (3, None, None), (999, None, 1)], "doc_id long, quality boolean, toxic int")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, source from '{SF}/documents.parquet' order by doc_id").fetchall()


def rows_of(df, key="doc_id"):
    return {getattr(r, key): r for r in df.collect()}


def oracle(name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark", "embeddings", "sales", "client_changes"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con.sql(queries.ORACLES[name]).df()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    ours, theirs = queries.QUERIES[name](spark, SF).toPandas(), oracle(name)
    cols = sorted(theirs.columns)
    assert sorted(ours.columns) == cols
    assert sorted(map(str, ours[cols].astype(str).values.tolist())) == sorted(map(str, theirs[cols].astype(str).values.tolist()))


def test_words_of_sliced_texts():
    texts = utf8(pa.array(ODD))
    distinct, codes, bounds = words(texts.slice(3, 9))
    found = [distinct[int(c)].as_py().decode() for c in codes]
    assert [found[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [split(t) for t in ODD[3:12]]


@pytest.mark.parametrize("high", [1, 2, 7, 50_000, 2**31, 2**59, 2**64])
def test_simple8b_round_trip(high):
    gen = np.random.default_rng(high % 97)
    for n in (0, 1, 239, 240, 1023, 1024, 1025, 4000):
        ids = gen.integers(0, high - 1, n, dtype=np.uint64, endpoint=True)
        ids[n // 3 : n // 2] = 0
        if high == 2**64:
            ids[n // 2 : n // 2 + 9] = np.uint64(2**64 - 1)
        assert (tokens.unpack(tokens.pack(ids)) == ids).all()
        coded, offsets = tokens.encode(ids)
        if n > 2048:
            assert (tokens.decode(coded, offsets, 1, 2) == ids[1024:2048]).all()


def test_op1(spark, odd, docs):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(BPE)
    marked = ["<|endoftext|> at first", "in <|endoftext|> between", "a<|endoftext|>b  <|endoftext|>", "at last <|endoftext|>", "a <|endoftext|", "Ġ Ġa \x1c b\u3000 c"]
    odd = odd.unionByName(spark.createDataFrame([(2000 + k, t) for k, t in enumerate(marked)], "doc_id long, text string"), allowMissingColumns=True)
    for source, found in ((docs, queries.op1_simple8b_tokens(spark, SF).collect()), ([(r.doc_id, r.text) for r in odd.collect()], tokens.read_tokens(tokens.write_tokens(odd, BPE)).collect())):
        source = sorted(source, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        found = sorted(found, key=lambda r: r.start)
        start = 0
        for (doc_id, text, *_), r in zip(source, found, strict=True):
            ids = [*tool.encode(text or "", add_special_tokens=False).ids, 0]
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
            start += len(ids)
    assert tokens.read_tokens(tokens.write_tokens(odd.limit(0), BPE)).count() == 0


def _media(text):
    raw = (text or "").encode()
    full = raw + b"\0" * (-len(raw) % 64 if raw else 64)
    return len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]), len(full) + 44


def test_op2(spark, odd, docs):
    for source, found in ((docs, queries.op2_media_chunks(spark, SF)), ([(r.doc_id, r.text) for r in odd.collect()], media.read_media(*media.write_media(odd)))):
        want = Counter((d, *_media(t)) for d, t, *_ in source)
        rows = found.collect()
        assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes) for r in rows) == want
        assert len({(r.media_sha256, r.feature) for r in rows}) == len({r.payload_sha256 for r in rows})
    assert media.read_media(*media.write_media(odd.limit(0))).count() == 0


def test_op2_long_texts_that_are_shared(spark):
    text = random.Random(2).randbytes(2 << 20).hex()
    docs = spark.createDataFrame([(k, text) for k in range(4)], "doc_id long, text string")
    manifest, chunks = media.write_media(docs)
    # All of the many chunks occur as often as each other: none has a large share, and none is broadcast.
    assert chunks.count() > HOT_SHARE > chunks.filter("uses > 0").count()
    assert {tuple(r)[:6] for r in media.read_media(manifest, chunks).collect()} == {(k, *_media(text)) for k in range(4)}
    manifest, chunks = media.write_media(spark.createDataFrame([(k, "same") for k in range(8)], "doc_id long, text string"))
    assert [r.uses for r in chunks.collect()] == [8] and media.read_media(manifest, chunks).count() == 8


def test_op2_hashes_long_texts_in_windows():
    data = random.Random(3).randbytes(media.WINDOW * 4 + 77)
    whole = media.gear(np.frombuffer(data, dtype=np.uint8)) & np.uint32((1 << media.CUT_BITS) - 1)
    tracemalloc.start()
    found = media._places(np.frombuffer(data, dtype=np.uint8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist() == (np.flatnonzero(whole == 0) + 1).tolist() and peak < 4 * len(data)



def test_chunks_follow_content():
    gen = random.Random(1)
    data = bytes(gen.randrange(256) for _ in range(200_000))
    one, two = media.cuts([data, b"moved" + data])
    assert len({b - a for a, b in zip([0, *one], one)} & {b - a for a, b in zip([0, *two], two)}) > 0
    assert len({e + 5 for e in one} & set(two)) > 0.9 * len(one)
    assert max(b - a for a, b in zip([0, *one], one)) <= media.MOST and media.cuts([b"\0" * 64]) == [[64]]


def test_op3(spark):
    c = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    said = "<|im_end|><|im_start|>assistant ok"
    c += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    check_chat(queries.op3_prefix_targets(spark, SF), c)


def check_chat(found, turns):
    found = rows_of(found, "conv_id")
    groups = {}
    for conv, turn, role, text in sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        groups.setdefault(conv, []).append((role or "", text or ""))
    assert set(found) == set(groups)
    for conv, own in groups.items():
        flat, loss = "".join(f"{r}\n{t}\n" for r, t in own), "".join(t for r, t in own if r == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(flat.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_op3_odd_rows(spark):
    turns = [(1, 0, "user", None), (1, 1, "assistant", "\\<|im_end|>\\\\<\\|<\\n"), (1, 1, "assistant", "\\<|im_end|>\\\\<\\|<\\n"), (1, 2, None, "tail"), (2, 0, "a\nb<\\n|<|", "only user\n"), (None, None, "assistant", LONG), (None, 3, "assistant", ""), (4, 0, "assistant", "x😀")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as example", "'y' as turns")
    check_chat(chat.read_back(chat.prefix_targets(df)), turns)
    rows = sorted(chat.prefix_targets(df.filter("conv_id = 1")).collect(), key=lambda r: r.example)
    assert [r.loss_start is None for r in rows] == [False, False, True] and rows[1].text.startswith(rows[0].text)
    assert chat.read_back(chat.prefix_targets(df.limit(0))).count() == 0
    plan = chat.read_back(chat.prefix_targets(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def check_shards(found, source, even=True):
    rows = found.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in source)
    by = {}
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    of = {}
    for r in rows:
        of.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    if even:
        sizes = [sum(r.size for r in own) for own in by.values()]
        assert len(sizes) == 16 and max(sizes) - min(sizes) < 0.02 * max(sizes)


def test_op4(spark, odd, docs):
    check_shards(queries.op4_byte_shards(spark, SF), [(d, t) for d, t, _ in docs], even=False)
    check_shards(sharding.shard_by_bytes(odd), [(r.doc_id, r.text) for r in odd.collect()], even=False)
    many = spark.range(3000).selectExpr("id as doc_id", "case when id % 40 = 0 then 'copy copy' else repeat('x', cast(id % 97 as int)) || id end as text")
    check_shards(sharding.shard_by_bytes(many), [(r.doc_id, r.text) for r in many.collect()])
    assert sharding.shard_by_bytes(odd.limit(0)).count() == 0
    parts = sharding.differencing([8, 7, 6, 5, 4], 2)  # the method's own result: 16 and 14, where 15 and 15 are possible
    assert sorted(sum(x for x, p in zip([8, 7, 6, 5, 4], parts) if p == k) for k in (0, 1)) == [14, 16]


def check_exact(found, source):
    groups = {}
    for d, t in source:
        groups.setdefault(re.sub(SPACE, "", t or ""), []).append((-len(t or ""), d is None, d or 0, d))
    want = Counter()
    for d, t in source:
        n = re.sub(SPACE, "", t or "")
        keep = min(groups[n])[3]
        want[d, keep, len(groups[n]), d == keep, hashlib.sha256(n.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()) == want


def test_op5(spark, odd, docs):
    check_exact(queries.op5_exact_dedup(spark, SF), [(d, t) for d, t, _ in docs])
    check_exact(exact.exact_duplicates(odd), [(r.doc_id, r.text) for r in odd.collect()])
    many = spark.range(4000).selectExpr("id as doc_id", "case when id % 3 = 0 then ' hot ' else 'text ' || id % 1500 end as text")
    check_exact(exact.exact_duplicates(many), [(r.doc_id, r.text) for r in many.collect()])
    assert exact.exact_duplicates(odd.limit(0)).count() == 0
    left = exact.drop_exact_duplicates(odd)
    assert left.columns == odd.columns and left.count() == len({re.sub(SPACE, "", r.text or "") for r in odd.collect()})


def test_op6(spark, odd, docs):
    for source, df in ((docs, queries.op6_pareto_mix(spark, SF)), ([(r.doc_id, r.text, r.source) for r in odd.collect()], mixing.mix(odd))):
        rows = df.collect()
        assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((d, s, len(split(t))) for d, t, s in source)
        sizes = Counter()
        for r in rows:
            sizes[r.source] += r.size
        want = mixing.targets(list(sizes.items()))
        assert all(r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source]) and 0 <= r.taken <= 3 * r.size and (r.taken == 0 or r.taken % r.size == 0) for r in rows)
        taken = Counter()
        for r in rows:
            taken[r.source] += r.taken
        assert all(taken[s] <= want[s] + 1e-6 for s in want)
        again = df.collect()
        assert Counter((r.doc_id, r.source, r.taken) for r in again) == Counter((r.doc_id, r.source, r.taken) for r in rows)
    even = mixing.mix(spark.range(6000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 50 as int)) as text", "case when id % 3 < 2 then 'hot' else 's' || id % 7 end as source")).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) < 0.01 * r["max(target)"] for r in even)
    assert mixing.mix(odd.limit(0)).count() == 0
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    assert Counter((r.doc_id, r.source) for r in out.collect()) == sum((Counter({(r.doc_id, r.source): r.taken // r.size}) for r in mixing.mix(odd).collect() if r.taken), Counter())


def test_targets_reshare_the_excess():
    t = mixing.targets([("a", 10), ("b", 1000), (None, 90)])
    assert t == {"a": 30.0, None: 270.0, "b": 800.0}  # two sources stop at 3 times their size, one after the other
    t = mixing.targets([("a", 10), ("b", 1000), (None, 900)])
    assert t["a"] == 30 and math.isclose(sum(t.values()), 1910) and math.isclose(t["b"] / t[None], 2)
    assert mixing.targets([("a", 0), ("b", 5)]) == {"a": 0.0, "b": 5.0}


def test_op7_learns_subwords():
    gen = random.Random(0)
    plain = lambda n: " ".join("".join(gen.choice("aeioulmnrst") for _ in range(gen.randrange(2, 8))) for _ in range(n))
    bad = ["vexgrob", "zupwick", "qadfloz"]

    def text(toxic, spoil=lambda w: w):
        w = plain(gen.randrange(5, 300)).split()
        for _ in range(3 * toxic):
            w.insert(gen.randrange(len(w)), spoil(gen.choice(bad)))
        return " ".join(w)

    y = [k % 4 == 0 for k in range(400)]
    model = toxicity.train([text(t) for t in y], [int(t) for t in y])
    fresh = [k % 2 == 0 for k in range(100)]
    for spoil in (lambda w: w, lambda w: w + "ly", lambda w: w + "!!"):
        s = model.scores(utf8(pa.array([text(t, spoil) for t in fresh])))
        assert ((s >= 0.5) == np.array(fresh)).mean() > 0.95
    assert toxicity.train([], []).scores(utf8(pa.array(["x", None]))).max() < 0.5


def test_op7_scores_every_passage_of_three_words():
    gen = random.Random(3)
    model = toxicity.Model(np.random.default_rng(1).normal(size=toxicity.BUCKETS), -0.5)
    texts = [" ".join(gen.choice("abcdefgh") * gen.randrange(1, 4) for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 6, 7, 50, 0, 2, 1)]
    one = {w: math.log(p / (1 - p)) + 0.5 for w in {w for t in texts for w in t.split()} for p in model.scores(utf8(pa.array([w])))}
    want = []
    for t in texts:
        v = [one[w] for w in t.split()]
        worst = max(sum(v[i : i + 3]) / len(v[i : i + 3]) for i in range(max(1, len(v) - 2))) if v else 0.0
        want.append(1 / (1 + math.exp(0.5 - worst)))
    assert np.allclose(model.scores(utf8(pa.array(texts))), want)
    # One word in front can't lower a text's score.
    for t in texts[4:9]:
        assert model.scores(utf8(pa.array(["z " + t])))[0] >= model.scores(utf8(pa.array([t])))[0]


def test_op7(spark, odd, labels):
    rows = toxicity.score_toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in rows)
    assert toxicity.score_toxicity(odd.limit(0), labels).count() == 0
    left = toxicity.drop_toxic(odd, labels.limit(0))
    assert left.columns == odd.columns and left.count() == odd.count()


def brute_components(source, k):
    sets = []
    for _, t in source:
        w = split(t)
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(source):
        least[root(i)] = min(least.get(root(i), (True, 0)), (d is None, d or 0))
    return Counter((d, len(s), None if least[root(i)][0] else least[root(i)][1]) for i, ((d, _), s) in enumerate(zip(source, sets, strict=True)))


def test_op8(spark, odd, docs):
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in queries.op8_lsh_forest(spark, SF).collect()) == brute_components([(d, t) for d, t, _ in docs], 4)
    source = [(r.doc_id, r.text) for r in odd.collect()]
    rows = neardup.near_duplicates(odd).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute_components(source, 5)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert neardup.near_duplicates(odd.limit(0)).count() == 0
    left = neardup.drop_near_duplicates(odd.filter("doc_id is not null"))
    assert left.columns == odd.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in rows if r.kept and r.doc_id is not None}


def test_op8_keeps_each_text_without_or_under_a_repeated_id(spark, odd):
    other = [(None, "some other text here without any id"), (None, "Some other text HERE without any id"), (None, ""), (5, "a second text under the id five"), (5, "a second text under the id five"), (None, "a b c d e f g h i j k l m n o p q r s t"), (None, "a b c d e f g h i j k l m n o p q r s u"), (7, "a b c d e f g h i j k l m n o p q r s v")]
    docs = odd.unionByName(spark.createDataFrame(other, "doc_id long, text string"), allowMissingColumns=True)
    source = [(r.doc_id, r.text) for r in docs.collect()]
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    alone = [(n, t) for n, t in source if not split(t)]
    least = {}
    # Each text's component under ids of its own: no two of them have equal names.
    ids = {k: n for k, (n, _) in enumerate(source)}
    named = [(k, t) for k, (_, t) in enumerate(source)]
    for k, (_, component) in zip(ids, sorted((d, c) for (d, _, c) in brute_components(named, 5)), strict=True):
        if split(source[k][1]):
            least.setdefault(component, []).append(k)
    want = Counter()
    for own in least.values():
        want[min((ids[k] is None, ids[k] or 0) for k in own)] += 1
    for n, _ in alone:
        want[n is None, n or 0] += 1
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in left.collect()) == want
    texts = {r.text for r in left.collect()}
    assert {"no id", "a second text under the id five"} <= texts and len({lower(t) for t in texts if t and "without any id" in lower(t)}) == 1


@pytest.mark.parametrize("seed", [3, 4])
def test_op8_dense_region(spark, seed):
    gen = random.Random(seed)
    base = [f"b{k}" for k in range(200)]
    source = []
    for d in range(150):
        w = list(base)
        for _ in range(gen.randrange(0, 9)):
            w[gen.randrange(len(w))] = f"n{gen.random()}"
        if seed == 4:  # sets of unequal sizes
            w = w[: len(w) - gen.randrange(0, 40)]
        source.append((d, " ".join(w)))
    found = neardup.near_duplicates(spark.createDataFrame(source, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(source, 5)


def test_components_of_a_long_chain(spark):
    n = 400
    order = list(range(n))
    random.Random(1).shuffle(order)
    name = lambda k: order[k].to_bytes(4, "big")
    edges = [(name(k), name(k + 1)) for k in range(n - 1) if k != 250]
    found = {bytes(r.node): bytes(r.component) for r in components(spark.createDataFrame(edges, "a binary, b binary").repartition(7)).collect()}
    assert found == {name(k): min(name(j) for j in (range(251) if k <= 250 else range(251, n))) for k in range(n)}


def check_lm(found, source):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in source]
    c = Counter()
    for (_, t), h in zip(source, held, strict=True):
        if not h:
            c.update([*split(t), None])
    total, mass = sum(c.values()), sum(c.values()) + len(c) + 1
    want = Counter()
    for (d, t), h in zip(source, held, strict=True):
        w = [*split(t), None]
        want[d, h, len(w), sum(c[x] > 0 for x in w), total, round(sum(math.log10((c[x] + 1) / mass) for x in w), 5)] += 1
    rows = found.collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
    assert all(r.score <= 0 for r in rows)
    return rows


def test_op9(spark, odd, docs, monkeypatch):
    rows = check_lm(queries.op9_lm_bloom(spark, SF), [(d, t) for d, t, _ in docs])
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)
    check_lm(lm.score_documents(odd), [(r.doc_id, r.text) for r in odd.collect()])
    monkeypatch.setattr(lm, "HEAD", 20)  # most tokens get their counts by the join
    check_lm(lm.score_documents(odd), [(r.doc_id, r.text) for r in odd.collect()])
    assert lm.score_documents(odd.limit(0)).count() == 0


def test_op9_filter_grows_with_the_corpus(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda own, x, put=type(spark.sparkContext).broadcast: sent.append(len(pickle.dumps(x))) or put(own, x))
    monkeypatch.setattr(lm, "MOST_BITS", 1 << 16, raising=False)  # a bound on the filter, as there was, would be passed by far
    monkeypatch.setattr(lm, "HEAD", 20)
    gen = random.Random(9)
    source = [(k, " ".join(f"w{int(gen.paretovariate(0.4)) % 5000}" for _ in range(200))) for k in range(300)]
    rows = rows_of(lm.score_documents(spark.createDataFrame(source, "doc_id long, text string")))
    one, two = Counter(), Counter()
    for d, t in source:
        if zlib.crc32(str(d).encode()) % 7 != 2:
            w = [*split(t), None]
            one.update(w)
            two.update(zip(w[:-1], w[1:], strict=True))
    value = lambda n: lm.VALUES[int(lm.levels(np.array([n]))[0])] if n else 0.0
    mass = sum(one.values()) + len(one) + 1
    far = []
    for d, t in source:
        w = [*split(t), None]
        want, before = 0.0, None
        for k, x in enumerate(w):
            p = (value(one[x]) + 1) / mass
            if k:
                p = (min(value(two[before, x]), value(one[before])) + lm.PRIOR * p) / (value(one[before]) + lm.PRIOR)
            want, before = want + math.log10(min(p, 1.0)), x
        far.append(abs(rows[d].score - want) / len(w))
    assert len(two) > 10_000 and max(far) < 0.1
    assert max(sent) < 2000  # no more than the most frequent tokens


def test_log_filter_never_forgets():
    gen = np.random.default_rng(5)
    keys = np.unique(gen.integers(0, 2**63, 20_000, dtype=np.uint64))
    counts = gen.geometric(0.2, len(keys))
    level = lm.levels(counts)
    parts = {}
    bucket = (keys >> np.uint64(64 - lm.PREFIX)).astype(int)
    for b in np.unique(bucket).tolist():
        own = bucket == b
        piece = np.zeros(max(8, int(level[own].sum())), dtype=np.uint8)
        for step in range(1, int(level[own].max()) + 1):
            for p in lm.places(keys[own & (level >= step)], step, np.uint64(len(piece) * 8)):
                np.bitwise_or.at(piece, (p >> np.uint64(3)).astype(int), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        parts[b] = piece.tobytes()
    found = lm.LogFilter(parts)
    assert (found.level(keys) >= level).all() and (found.level(keys) == level).mean() > 0.9
    assert (found.level(gen.integers(0, 2**63, 20_000, dtype=np.uint64)) == 0).mean() > 0.9


def test_op10(spark, odd, docs):
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for source, df in ((docs, queries.op10_sentencepiece(spark, SF)), ([(r.doc_id, r.text) for r in odd.collect()], pieces.encode_documents(odd, PIECES))):
        want = Counter()
        for d, t, *_ in source:
            ids = tool.encode(t or "", add_bos=True, add_eos=True)
            want[d, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(tool.decode(ids).encode()).hexdigest()] += 1
        rows = df.collect()
        assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want and all(r.agreed for r in rows)
    assert pieces.encode_documents(odd.limit(0), PIECES).count() == 0


def test_own_agenda_agrees_with_the_library():
    own = pieces.PieceEncoder(PIECES)
    for t in ODD:
        if t:
            ids = own.library.encode(t)
            found, fine = own.batch(utf8(pa.array([t])))[0]
            assert fine and found.tolist() == [1, *ids, 2]
            if len(t) < 10_000:
                symbols = np.array(own.merge(own.library.normalize(t)), dtype=np.int64)
                assert own.spelt(symbols, np.array([len(symbols)]))[0].tolist() == ids


def test_op10_takes_the_ids_of_the_library_for_every_whole_text():
    class Other:
        """A library that encodes whole texts otherwise than cut by cut."""

        def __init__(self, tool):
            self.tool, self.bos_id, self.eos_id, self.normalize = tool, tool.bos_id, tool.eos_id, tool.normalize

        def encode(self, x, **options):
            return [np.append(ids, 7) for ids in self.tool.encode(x, **options)]

    texts = utf8(pa.array([f"some words {k}" for k in range(300)]))
    own = pieces.PieceEncoder(PIECES)
    before = own.batch(texts)
    assert all(fine for _, fine in before)
    own.library = Other(own.library)
    for (ids, _), (other, fine) in zip(before, own.batch(texts), strict=True):
        assert not fine and other.tolist() == [*ids[:-1].tolist(), 7, *ids[-1:].tolist()]


def test_op10_merges_whole_texts_where_pieces_run_across_blanks(monkeypatch):
    own = pieces.PieceEncoder(PIECES)
    own.safe = False
    assert all(fine for _, fine in own.batch(utf8(pa.array([t for t in ODD if len(t or "") < 10_000]))))
    monkeypatch.setattr(pieces, "SHORT", 0)  # all cuts by the heap
    own.safe = True
    assert all(fine for _, fine in own.batch(utf8(pa.array([t for t in ODD if len(t or "") < 10_000]))))


def test_pipeline(spark, docs):
    out = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len({r.doc_id for r in out}) < len(docs)
    labels = corpus_pipeline.table(spark, SF, "labels")
    d = corpus_pipeline.table(spark, SF, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in toxicity.drop_toxic(d, labels).collect()]
    best = {}
    for r in rows:
        key = re.sub(SPACE, "", r[1])
        best[key] = min(best.get(key, (1, 0)), (-len(r[1]), r[0]))
    kept = {b[1] for b in best.values()}
    rows = [r for r in rows if r[0] in kept]
    first = {c for _, _, c in brute_components([r[:2] for r in rows], 5)}
    rows = [r for r in rows if r[0] in first]
    assert {r.doc_id for r in out} <= {r[0] for r in rows}
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(split(t))
    want, got = mixing.targets(list(sizes.items())), Counter()
    texts = {r[0]: r for r in rows}
    for r in out:
        got[texts[r.doc_id][2]] += len(split(texts[r.doc_id][1]))
    assert all(0 <= want[s] - got[s] < max(120, 0.25 * want[s]) for s in want)


def test_stages_take_odd_and_empty_tables(spark, odd):
    for docs in (odd.filter("doc_id is not null"), odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            before = docs.columns
            path = f"{corpus_pipeline.shared_dir(spark)}/odd-{random.random()}"
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns == before or "ids_sha256" in docs.columns


def test_stages_take_odd_tables_whole(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        path = f"{corpus_pipeline.shared_dir(spark)}/odd-{random.random()}"
        stage(spark, docs, SF).write.parquet(path)
        docs, before = spark.read.parquet(path), docs
        assert docs.columns == before.columns or "ids_sha256" in docs.columns


CLASHES = "__n,row,row_,times,rows,hashed,first,copy,sha,keep,points,best,class,kept,rep,copies,of_source,words,interval,digest,item,place".split(",")


def test_stages_keep_rows_of_any_column_names(spark):
    texts = [(None, "a text without an id that has words"), (None, "a text without an id that has words"), (None, "another one without an id"), (1, "copy of a text"), (2, "copy  of a\ntext "), (3, None), (4, ""), (5, "one id two texts"), (5, "two texts one id"), (6, "twice the same row"), (6, "twice the same row")]
    docs = spark.createDataFrame([(d, t, "s", *[str(k) for k in range(len(CLASHES))]) for d, t in texts], "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES))
    rows = lambda df: Counter((r.doc_id, r.text, *r[3:]) for r in df.collect())
    own = lambda *pairs: Counter((d, t, *[str(k) for k in range(len(CLASHES))]) for d, t in pairs)
    # Of copies the longest stays; null and empty texts are one text, whose smallest id stays.
    want = [(None, texts[0][1]), texts[2], texts[4], texts[5], texts[7], texts[8], texts[9]]
    assert rows(exact.drop_exact_duplicates(docs)) == own(*want)
    # Near copies stay by the smallest id; texts without words are alone.
    want = [(None, texts[0][1]), texts[2], texts[3], texts[5], texts[6], texts[7], texts[8], texts[9]]
    assert rows(neardup.drop_near_duplicates(docs)) == own(*want)
    taken = Counter()
    for r in mixing.mix(docs).collect():
        if r.size:
            taken[r.doc_id, r.size] += r.taken // r.size
    got = Counter()
    for r in mixing.mixed_documents(docs).collect():
        assert tuple(r[3:]) == tuple(str(k) for k in range(len(CLASHES)))
        got[r.doc_id, len(split(r.text))] += 1
    assert got == +taken
    assert rows(toxicity.drop_toxic(docs, spark.createDataFrame([], "doc_id long, toxic int"))) == own(*texts)


def test_very_long_texts(spark):
    from tokenizers import Tokenizer

    gen = random.Random(8)
    long = " ".join(f"w{gen.randrange(5000)}{'.,' [gen.randrange(2)]}" for _ in range(2_800_000))
    assert len(long) > 17_000_000
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "short")], "doc_id long, text string")
    tool = Tokenizer.from_file(BPE)
    want = {d: len(tool.encode(t, add_special_tokens=False).ids) + 1 for d, t in ((1, long), (3, "short"))}
    found = rows_of(tokens.read_tokens(tokens.write_tokens(docs, BPE)))
    assert len(found) == 3 and all(found[d].n_tokens == n for d, n in want.items())
    found = rows_of(media.read_media(*media.write_media(docs)))
    assert all((found[d].n_bytes, found[d].payload_sha256) == (_media(t)[0], _media(t)[2]) for d, t in ((1, long), (3, "short")))
    assert {r.doc_id for r in exact.drop_exact_duplicates(docs).collect()} == {1, 2, 3}
    assert rows_of(neardup.near_duplicates(docs))[2].component_id == 1
    assert rows_of(lm.score_documents(docs))[1].n_tokens == 2_800_001
    assert all(r.agreed for r in pieces.encode_documents(docs, PIECES).collect())
    assert sharding.shard_by_bytes(docs).count() == 3 and mixing.mix(docs.selectExpr("*", "'s' as source")).count() == 3


def test_scratch_folders_go_with_their_stage(spark, odd):
    other = exact.exact_duplicates(odd)
    stage = corpus_pipeline.STAGES[1][1]
    first = stage(spark, odd, SF)
    n = first.count()
    stage(spark, odd, SF)
    assert other.count() == odd.count() and n > 0  # what another caller has made is there
    with pytest.raises(Exception):
        first.count()


def test_op4_deals_as_differencing_does(spark):
    gen = random.Random(2)
    texts = [(k, "x" * gen.randrange(1, 400) + str(k)) for k in range(300)]
    rows = sharding.shard_by_bytes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    # Items: groups of a fair part of a shard, all others by their bin.
    total, by = sum(r.size for r in rows), {}
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("doc_id", f"pmod(xxhash64(unhex(md5(cast(text as binary)))), {sharding.BINS}) as bin")
    bins = {r.doc_id: r.bin for r in df.collect()}
    for r in rows:
        by.setdefault(("text", r.doc_id) if r.size >= total // (16 * sharding.HEAVY) else ("bin", bins[r.doc_id]), []).append(r)
    parts = [sorted([0] * 15 + [sum(r.size for r in own)]) for own in by.values()]
    while len(parts) > 1:  # the two of largest spread, put together in opposite order
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b, *rest = parts
        parts = [*rest, sorted(x + y for x, y in zip(a, reversed(b), strict=True))]
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.size
    spread = max(sums.values()) - min(sums.values())
    # Ties between spreads may be broken otherwise; the result is as even.
    assert len(sums) == 16 and abs(spread - (parts[0][-1] - parts[0][0])) <= 400 and spread <= max(r.size for r in rows)
    assert all(len({r.shard for r in own}) == 1 for own in by.values())


def test_op6_draws_as_pareto_sampling_does(spark):
    gen = random.Random(6)
    docs = [(k, " ".join(["w"] * gen.randrange(0, 60)), gen.choice(["a", "a", "a", "b", "c", None])) for k in range(400)]
    rows = rows_of(mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")))
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(t.split())
    want = mixing.targets(list(sizes.items()))
    for source, target in want.items():
        own = [(d, len(t.split())) for d, t, s in docs if s == source]
        whole = min(int(target // sizes[source]), 3)
        gap = target - whole * sizes[source]
        fits = [n for _, n in own if 0 < n <= gap]
        level = gap / max(sum(fits) - sum(n * n for n in fits) / max(gap, 1.0), 1.0)

        def rank(d, n, gap=gap, level=level):
            u = (int(hashlib.md5(f"mix:{d}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            p = min(max(level * (1 - n / max(gap, 1.0)), 1e-12), 1 - 1e-12)
            return (u / (1 - u)) / (p / (1 - p)), d

        copies, done = {d: whole * (n > 0) for d, n in own}, 0
        first, order = dict(copies), sorted(own, key=lambda x: rank(*x))
        while True:
            left, taken = gap, 0
            for d, n in order:
                if 0 < n <= gap and copies[d] < 3 and (done > 1 or copies[d] == first[d]):
                    taken += n
                    if taken > gap:
                        break
                    copies[d] += 1
                    left -= n
            gap, done = left, done + 1
            if done > 2 and not (gap > mixing.NEAR * target and any(0 < n <= gap and copies[d] < 3 for d, n in own)):
                break
        # Another source may call for more passes, which fill this one further.
        differ = [d for d, n in own if rows[d].taken != copies[d] * n]
        assert all(rows[d].taken > copies[d] * n for d, n in own if d in differ) and len(differ) <= 3
        assert sum(rows[d].taken for d, _ in own) <= target + 1e-6


def test_op7_query_on_held_out_rows(spark):
    big = SF.replace("sf0.001", "sf0.1")
    y = dict(duckdb.sql(f"select doc_id, max(toxic) from '{big}/labels.parquet' where toxic is not null group by 1").fetchall())
    rows = queries.QUERIES["op7_toxicity"](spark, big).collect()
    assert len(rows) == duckdb.sql(f"select count(*) from '{big}/documents.parquet'").fetchall()[0][0]
    held = [r for r in rows if r.held_out and r.doc_id in y]
    toxic, clean = [r.score for r in held if y[r.doc_id]], [r.score for r in held if not y[r.doc_id]]
    area = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    caught = [y[r.doc_id] for r in held if r.predicted]
    print("AUC", round(area, 3), "recall", round(sum(caught) / len(toxic), 3), "precision", round(sum(caught) / len(caught), 3), len(held), len(toxic))
    assert area > 0.9 and sum(caught) / len(toxic) > 0.7 and sum(caught) / len(caught) > 0.75
