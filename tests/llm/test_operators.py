import math
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from brute import prose
from harness import duck, rows_of_duck, rows_of_spark

import __spark_entry__ as E
from exonloom.llm import lattice, mixing, near, packing, pages, quality, sharding, spans, tokens, vectors
from exonloom.llm.common import texts_of
from exonloom.llm.components import components
from exonloom.llm.queries import crc_of_ids, packed, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(make_docs, odd_rows):
    return make_docs(odd_rows, clash=True)


@pytest.fixture(scope="module")
def none(make_docs):
    return make_docs([])


def test_texts_split_and_hash():
    texts = ["a b  c\n d", "", None, " x ", "é ñandú x", "w" * 300000 + " b", "a b c d e f"] * 3
    seen = {}
    for most in (8, 1000, 1 << 22):
        got = []
        for _, t in texts_of(pa.array(texts), most):
            got += [[t.word(w) for w in range(t.first[k], t.first[k + 1])] for k in range(len(t))]
            for w in range(len(t.starts)):
                assert seen.setdefault(t.word(w), t.hashes[w]) == t.hashes[w]
            _, at = t.windows(3)
            assert at.tolist() == [w for k in range(len(t)) for w in range(t.first[k], t.first[k + 1] - 2)]
        assert got == [(x or "").encode().split() for x in texts]
    assert len(set(seen.values())) == len(seen)


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizer_path()), tokens.Encoder(tokenizer_path())
    for text in ["a\n\nb", "  x", "it's John's 'll x", " a b", "a\0b", "", "日本 語 😀 😀a", "x\r\ny 3.5 a1b2", "a\x85b a　b"]:
        assert own.ids(text) == own.plain_ids(text) == library.encode(text, add_special_tokens=False).ids
    for text in ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext|", "é<|endoftext|> é"]:
        assert own.ids(text) == library.encode(text, add_special_tokens=False).ids
        assert (own.ids(text) == own.plain_ids(text)) == ("<|endoftext|>" not in text)
    assert len(own.ids("a <|endoftext|> b")) == 4 and own.ids(None) == []


def test_length_histogram(odd, odd_rows, none):
    totals = tokens.suffix_totals(tokens.length_histogram(odd, tokenizer_path()), width=4)
    own = tokens.Encoder(tokenizer_path())
    lengths = [len(own.ids(t)) + 1 for _, t, _ in odd_rows]
    rows = {r["length"]: r for r in totals.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r["docs"] == lengths.count(n) and r["docs_from"] == sum(x >= n for x in lengths) and r["tokens_from"] == sum(x for x in lengths if x >= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths) and math.isclose(r["quantile"], sum(x <= n for x in lengths) / len(lengths))
    limits = [1, 7, 100, 10**9]
    assert {r["limit"]: (r["docs_over"], r["tokens_kept"]) for r in tokens.at_limits(totals, limits).collect()} == {m: (sum(x > m for x in lengths), sum(min(x, m) for x in lengths)) for m in limits}
    assert {r["share"]: r["length"] for r in tokens.quantiles(totals, [0.5, 1.0]).collect()} == {0.5: sorted(lengths)[(len(lengths) - 1) // 2], 1.0: max(lengths)}
    assert tokens.suffix_totals(tokens.length_histogram(none, tokenizer_path())).count() == 0


def test_packing(odd, odd_rows, none):
    got = packed(odd).toPandas()
    own = tokens.Encoder(tokenizer_path())
    assert len(got) == sum(-(-(len(own.ids(t)) + 1) // 2048) for _, t, _ in odd_rows)
    for i, t, _ in odd_rows:
        if i is None or i == 9:
            continue
        ids = np.array([*own.ids(t), 0], "<u4")
        mine = got[got.doc_id == i].sort_values("piece")
        assert mine.start.tolist() == [0, *mine.length.cumsum()[:-1]] and mine.length.sum() == len(ids)
        assert (mine.length.iloc[1:] == 2048).all()
        assert mine.ids_crc32.tolist() == [zlib.crc32(struct.pack(f"<{n}I", *ids[s:s + n])) for s, n in zip(mine.start, mine.length)]
    got = got.sort_values(["sequence_id", "offset"])
    ends = got.groupby("sequence_id").length.cumsum()
    assert (ends - got.length == got.offset).all() and ends.max() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packed(none).count() == 0
    assert packing.pieces(odd.limit(1), tokenizer_path()).schema["ids"].dataType.simpleString() == "array<int>"


def test_genetic_packing_is_valid_and_no_worse_than_best_fit():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 2048, 500), rng.integers(600, 1100, 400), np.full(300, 700)):
        start = packing.Packing(packing.best_fit(np.full(len(lengths), -1), lengths, np.argsort(-lengths), 2048), lengths, 2048)
        best = packing.evolve(lengths, [], 2048, 4, 20, rng)
        assert best.loads.max() <= 2048 and best.loads.sum() == lengths.sum() and best.cost <= start.cost


def test_near_duplicates(spark, make_docs, none):
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(60):
        w = prose(rng, 150, 100000).split()
        texts.append(" ".join(w))
        for edits in range(int(rng.integers(0, 5))):
            x = list(w)
            for k in rng.integers(0, 150, 1 + 2 * edits):
                x[k] = f"new{rng.integers(10**6)}"
            texts.append(" ".join(x))
    texts += [texts[0]] * 5 + ["short text", "short  text", "other one", "", None, " "]
    rows = [(i * 3, t, "s") for i, t in enumerate(texts)]
    rows += [rows[1], rows[1]]
    docs = make_docs(rows, clash=True)
    got = near.classes(docs).toPandas()
    sets = [brute.shingles(t) for t in texts]
    links = [(i, j) for j in range(len(texts)) for i in range(j) if (texts[i] or "") == (texts[j] or "") or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    expected = {i * 3: r * 3 for i, r in enumerate(brute.components(len(texts), links))}
    assert dict(zip(got.doc_id, got.class_id)) == expected
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))
    assert near.classes(none).count() == 0 and near.one_of_each(none).count() == 0


def test_hot_group_that_hangs_on_its_original(make_docs):
    rng = np.random.default_rng(12)
    w = [f"o{i}" for i in range(154)]
    texts = []
    for c in range(300):
        x = list(w)
        for k in rng.permutation(30)[:3] * 5 + 4:
            x[k] = f"c{c}k{k}"
        texts.append(" ".join(x))
    texts.insert(150, " ".join(w))
    sets = [brute.shingles(t) for t in texts]
    alike = [(i, j, len(sets[i] & sets[j]) / len(sets[i] | sets[j])) for j in range(len(texts)) for i in range(j)]
    assert all(0.8 <= s < 0.85 for i, j, s in alike if 150 in (i, j)) and sum(s >= 0.8 for *_, s in alike) < 600
    part = brute.components(len(texts), [(i, j) for i, j, s in alike if s >= 0.8])
    texts += [prose(rng, 150, 10**6) for _ in range(600)]
    got = near.classes(make_docs([(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(enumerate([*part, *range(301, 901)]))


def test_open_buckets_are_compared_in_blocks(spark):
    rng = np.random.default_rng(0)
    texts = []
    for _ in range(13):
        w = prose(rng, 60, 10**6).split()
        texts += [" ".join(w[:59 - k % 3]) for k in range(100)]
    rows = [(5, 0, 1300, i, i % 2 + 2 * (i // 100), np.zeros(48, np.uint32).tobytes(), t) for i, t in enumerate(texts)]
    members = spark.createDataFrame(rows, "bucket long, band int, size long, node long, part long, samples binary, text string")
    idf = spark.sparkContext.broadcast(np.ones(near.FEATURES, np.float32))
    got = near.open_links(members, idf, 0.8).collect()
    assert all(r["u"] // 100 == r["v"] // 100 and (r["u"] - r["v"]) % 2 for r in got)
    # members of a class hang together already, so each family needs one link between its classes
    assert {r["u"] // 100 for r in got} == set(range(13))


def test_consistent_samples_agree_as_often_as_similar():
    rng = np.random.default_rng(9)
    h = (rng.integers(0, 2**63, 6000) >> 19).astype(np.uint64)
    w = rng.uniform(0.5, 8, 6000).astype(np.float32)
    a, b = slice(0, 4000), slice(1000, 6000)
    s = near.sample(np.concatenate([h[a], h[b]]), np.concatenate([w[a], w[b]]), np.array([0, 4000]))
    many = [near.sample(np.concatenate([(near.mix(h[a] + np.uint64(k)) >> np.uint64(20)), (near.mix(h[b] + np.uint64(k)) >> np.uint64(20))]), np.concatenate([w[a], w[b]]), np.array([0, 4000])) for k in range(40)]
    agree = np.mean([(m[0] == m[1]).mean() for m in [s, *many]])
    assert abs(agree - w[1000:4000].sum() / w.sum()) < 0.03


def test_lattice(spark, make_docs, odd, odd_rows, none):
    units = lattice.Units(tokenizer_path("piece_bpe_32k.model"))
    p = np.append(units.start, units.start[~units.opens].sum())
    weights = units.weights(p)
    for word in (b"the", b"thaten", "é漢".encode(), b"x"):
        first, rest = weights.by_string

        def ways(at, opened):
            if not opened:
                return sum(math.exp(first[word[:n]]) * ways(n, True) for n in range(1, len(word) + 1) if word[:n] in first) + math.exp(weights.bare) * ways(0, True)
            if at == len(word):
                return math.exp(weights.stop)
            return sum(math.exp(rest[word[at:n]]) * ways(n, True) for n in range(at + 1, len(word) + 1) if word[at:n] in rest)

        row = np.frombuffer(word, np.uint8)[None, :]
        assert math.isclose(weights.forward(row)[0], math.log(ways(0, False)), rel_tol=1e-9)
        assert math.isclose(weights.long_word(word), weights.forward(row)[0], rel_tol=1e-9)
        into = [np.zeros(len(x)) for x in weights.logs] + [np.zeros(2)]
        weights.forward(row, np.ones(1), into)
        assert math.isclose(into[0].sum() + into[2][0], 1, rel_tol=1e-9)  # one opening unit per word
        bytes_used = sum(n * len(s) for k in (0, 1) for n, s in zip(into[k], units.tables[k][4]))
        assert math.isclose(bytes_used, len(word), rel_tol=1e-9)

    got = lattice.score(odd, tokenizer_path("piece_bpe_32k.model")).collect()
    assert len(got) == len(odd_rows)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    for i, t, _ in odd_rows:
        if not held(i):
            counts.update([*brute.words((t or "").translate(low)), None])
    n, v = sum(counts.values()), len(counts)
    expected = sorted((str(i), held(i), round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*brute.words((t or "").translate(low)), None]), 4)) for i, t, _ in odd_rows)
    assert sorted((str(r["doc_id"]), r["held_out"], round(r["base_score"], 4)) for r in got) == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) and r["train_tokens"] == n for r in got)
    assert lattice.score(none, tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_long_words_count_in_refining(spark, monkeypatch):
    units = lattice.Units(tokenizer_path("piece_bpe_32k.model"))
    p = np.append(units.start, units.start[~units.opens].sum())
    words = ["thaten" * 11, "the" * 21, "the" * 21 + "x", "the" * 21 + "xy", "漢字" * 10 + "漢", "漢字" * 11, "https://example.org/" + "a/long-path/" * 9]
    assert {len(w.encode()) for w in words} >= {63, 64, 65, 66}
    weights, found = units.weights(p), []
    for short in (lattice.SHORT, 10**4):
        monkeypatch.setattr(lattice, "SHORT", short)
        found.append([np.zeros(len(x)) for x in weights.logs] + [np.zeros(2)])
        weights.words(lattice.as_texts(pa.array([w.encode() for w in words])), np.arange(1.0, 8.0), found[-1])
    for x, y in zip(*found):
        assert np.allclose(x, y, rtol=1e-9, atol=1e-12)
    types = spark.createDataFrame([(w.encode(), 1) for w in words], "word binary, c long")
    gain = lattice.refine(types, units, p) - 0.01 * weights.p
    assert math.isclose(gain[-1], len(words), rel_tol=1e-9) and math.isclose(gain[:-1][units.opens].sum(), len(words), rel_tol=1e-9)


def test_lattice_beats_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = lattice.score(docs, tokenizer_path("piece_bpe_32k.model")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_quality(spark, make_docs, odd, odd_rows, none):
    judged = quality.judge(odd, None)
    assert judged.columns == [c for c in odd.columns if c not in ("kept", "score")] + [*quality.BASE, "base_failed", "score", "kept"]
    for r in judged.select("text", *quality.BASE, "base_failed").collect():
        base = brute.quality_counts(r[0])
        assert list(r[1:6]) == base
        assert r[6] == (base[0] < 10 or 100 * base[4] > 20 * base[0])
    assert quality.judge(none, None).count() == 0
    docs, labels = spark.read.parquet(f"{FOLDER}/../sf0.01/documents.parquet"), spark.read.parquet(f"{FOLDER}/../sf0.01/labels.parquet")
    assert quality.train(docs, labels.where("false")) is None
    odd_ids = labels.where("doc_id % 2 = 1")
    forest = quality.train(docs, odd_ids)
    got = quality.judge(docs, forest).join(labels.where("doc_id % 2 = 0"), "doc_id").toPandas()
    assert (got.kept[got.quality == 1]).mean() > 0.9 and (got.kept[got.quality == 0]).mean() < 0.05


def test_forest_is_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.STATISTICS)))
    y = (rng.random(3000) < 1 / (1 + np.exp(6 * x[:, 2] - 3 + 4 * (x[:, 0] > 0.5) * x[:, 4]))).astype(float)
    forest = quality.boost(x, y, trees=15)
    for name in quality.FALLING:
        f = quality.STATISTICS.index(name)
        grid = np.repeat(x[:40], 25, 0)
        grid[:, f] = np.tile(np.linspace(0, 1, 25), 40)
        assert (np.diff(forest.score(grid).reshape(40, 25), axis=1) <= 1e-12).all()
    assert forest.feature.shape == forest.value.shape


def test_sharding(spark, odd, odd_rows, none):
    one = odd.select("doc_id", "text").withColumn("weight", F.lit(1).cast("long"))
    for shards, nodes in ((40, 64), (3, 5), (7, 1)):
        got = sharding.assign(one, key=("doc_id", "text"), shards=shards, nodes=nodes).toPandas()
        n = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
        sizes = n["count"].reindex(range(shards), fill_value=0)
        assert len(got) == len(odd_rows) and sizes.max() - sizes.min() <= 1
        assert (n["min"] == 0).all() and (n["max"] == n["count"] - 1).all() and (n["nunique"] == n["count"]).all()
    assert sharding.assign(none).count() == 0
    many = spark.range(20000).selectExpr("id as doc_id", "100 + id % 50 as bytes")
    got = sharding.assign(many, load="bytes", shards=10, nodes=16, slack=0.02).groupBy("shard").agg(F.sum("bytes").alias("b")).toPandas()
    assert len(got) == 10 and got.b.max() <= 1.03 * got.b.mean()
    same = spark.range(5000).selectExpr("1 as doc_id")
    assert {r["count"] for r in sharding.assign(same, shards=10, nodes=4).groupBy("shard").count().collect()} == {500}


def test_sharding_moves_little_with_slack(spark):
    rows = spark.range(20000).selectExpr("id as doc_id")
    a, b = (sharding.assign(rows, shards=s, slack=1.0).select("doc_id", F.col("shard").alias(f"s{s}")) for s in (20, 21))
    assert a.join(b, "doc_id").where("s20 <> s21").count() < 0.3 * 20000


@pytest.mark.parametrize("shards, nodes, slack, weigh", [(40, 64, 0.0, False), (7, 1, 0.0, False), (3, 5, 0.0, True), (10, 16, 0.2, True), (5, 8, 1.0, False)])
def test_sharding_matches_a_walk(spark, shards, nodes, slack, weigh):
    """Each shard keeps its own rows in ring order up to its capacity; the others queue and walk on."""
    rows = spark.range(1200).selectExpr("id as doc_id", "1 + id % 50 as bytes")
    got = {r.doc_id: r.shard for r in sharding.assign(rows, load="bytes" if weigh else None, shards=shards, nodes=nodes, slack=slack).collect()}
    ring = sorted((r.cell, r.shard, r.v) for r in sharding._nodes(spark, shards, nodes).collect())
    place = F.xxhash64(F.lit("row"), "doc_id")
    keyed = rows.select("doc_id", "bytes", place.alias("place"), F.pmod(F.shiftrightunsigned(place, 20), F.lit(sharding.CELLS)).alias("cell")).collect()
    load = {r.doc_id: r.bytes if weigh else 1 for r in keyed}
    total = math.ceil(sum(load.values()) * (1 + slack))
    cap = [total // shards + (s < total % shards) for s in range(shards)]
    held, wait = [0] * shards, [[] for _ in range(len(ring) + 1)]
    want = {}
    for r in sorted(keyed, key=lambda r: (r.cell, r.place)):
        arc = sum(c < r.cell for c, _, _ in ring)
        s = ring[arc % len(ring)][1]
        held[s] += load[r.doc_id]
        if held[s] - load[r.doc_id] < cap[s]:
            want[r.doc_id] = s
        else:
            wait[arc].append(r.doc_id)
    if weigh:  # the rows that fill a shard may pass its capacity
        assert set(want.items()) <= set(got.items()) and len(got) == len(rows.collect())
        sums = np.bincount([got[k] for k in load], [load[k] for k in load], shards)
        assert (sums <= np.array(cap) + 2 * 50).all()
        return
    room = [max(0, c - h) for c, h in zip(cap, held)]
    queue = []
    for lap in range(2):
        for arc, late in enumerate(wait):
            queue += late if lap == 0 else []
            s = ring[arc % len(ring)][1]
            while queue and room[s]:
                room[s] -= 1
                want[queue.pop(0)] = s
    assert not queue and got == want


def test_sharding_moves_few_rows_without_slack(spark):
    rows = spark.range(20000).selectExpr("id as doc_id")
    a, b = (sharding.assign(rows, shards=s).select("doc_id", F.col("shard").alias(f"s{s}")) for s in (40, 41))
    assert a.join(b, "doc_id").where("s40 <> s41").count() < 0.25 * 20000


def test_mixing(spark, make_docs, odd, none):
    lean = odd.drop("size", "copies").withColumn("size", mixing.F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")).fillna(0, ["size"])
    got = mixing.copies(lean).toPandas()
    assert (got.copies <= 3).all() and (got.copies >= 0).all()
    assert math.isclose(got.groupby("source", dropna=False).target.first().sum(), got["size"].sum(), rel_tol=1e-9)
    assert got.equals(got) and sorted(mixing.copies(lean).select("doc_id", "copies").collect(), key=str) == sorted(mixing.copies(lean.repartition(5)).select("doc_id", "copies").collect(), key=str)
    assert mixing.mix(lean).columns == lean.columns and mixing.mix(lean).count() == got.copies.sum()
    empty = none.withColumn("size", F.lit(0).cast("long"))
    assert mixing.copies(empty).count() == 0
    zero = make_docs([(1, None, "a"), (2, "", None)]).withColumn("size", F.lit(0).cast("long"))
    assert [r["copies"] for r in mixing.copies(zero).collect()] == [0, 0]


def test_mix_matches_sql(spark):
    assert rows_of_spark(E.queries()["op8_source_mix"](spark, FOLDER)) == rows_of_duck(duck(FOLDER), E.oracle_sql()["op8_source_mix"])


def test_pages(spark):
    page = """<!DOCTYPE html><head><title>no</title><script>var t="</p><p>no";</script></head><body><nav><ul><li><a href=/>Menu no</a></ul></nav><!-- <p>no</p> --><header><h1>Site no</h1></header>
    <div id="cookie-notice">Cookies no <b>no</b></div><div class="content"><h2>Title &amp; more</h2><p>A long first   paragraph<br>with a break and caf&eacute;.<p>Short.<div class=ad>no buy now</div><p>Last &lt;one&gt;&nbsp;x</p></div>
    <aside>no</aside><form>no<input><select><option>no</select></form><section class="comments"><p>no, a reader writes a lot of words here, far more than the article has in any line of it</p></section><footer>no</footer>"""
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "plain"), (5, "u", "<article><h1>T</h1><p>a</p><div class='ad'>no</div><p>b</article><div>" + "other " * 400 + "</div>"), (7, "u", "<div>" + "x " * 30 + "</div><article><h1>T</h1>" + "<p>word word word word</p>" * 9 + "<div class='ads'>no</div><nav>no</nav><ul><li><a href=/>no</a></ul><p>b</article>"), (6, "u", "<nav>only</nav>"), (1, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = pages.extract(df)
    texts = {r["page_id"]: r["text"] for r in got.collect()}
    assert texts == {1: "Title & more A long first paragraph with a break and café. Short. Last <one> x", 2: "", 3: "", 4: "plain", 5: "T a b " + ("other " * 400).strip(), 6: "", 7: "T " + "word word word word " * 9 + "no b"}
    assert got.count() == 8 and pages.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("attrs", ['class="has-sidebar"', 'class="no-sidebar"', 'class="content-sidebar-wrap"', "class=search-page", 'id="with-menu"'])
def test_pages_in_a_layout_wrapper(attrs):
    text = "<h1>Title</h1>" + "<p>word word word word</p>" * 4
    for inner in (f"<article>{text}</article>", f"<main>{text}</main>", f"<div>{text}</div>"):
        assert pages.main_text(f"<body><div {attrs}>{inner}</div><footer>no</footer></body>") == "Title" + " word" * 16


def test_article_in_a_side_wrapper():
    article = "<article><p>word word word</p><div class='ad'>no</div></article>"
    for wrapper in ("div class='page search'", "form id=all", "div role=search", "div class='sidebar-box'"):
        assert pages.main_text(f"<{wrapper}>{article}<p>no</p></{wrapper.split()[0]}>") == "word word word"
    for wrapper in ("div class='related-posts'", "section id=comments", "aside", "div hidden", "nav"):
        assert pages.main_text(f"<p>one two</p><{wrapper}>{article * 9}</{wrapper.split()[0]}>") == "one two"


def test_pages_without_article_keep_all_of_their_container():
    half = "<p>one two three four</p>" * 3
    toc = "<ul>" + "".join(f"<li><a href=#{k}>part {k}</a></li>" for k in range(8)) + "</ul>"
    side = "<div class=share>" + "<p>no</p>" * 8 + "</div>"
    words, parts = " ".join(["one two three four"] * 3), " ".join(f"part {k}" for k in range(8))
    menu = "<div>" + "".join(f"<p><a href=/{k}>no</a></p>" for k in range(8)) + "</div>"
    assert pages.main_text(f"{menu}<div>{half}{side}{half}x</div>{menu}") == f"{words} {words} x"
    assert pages.main_text(f"{menu}<div>{half}{toc}{half}<p>x</p></div>{menu}") == f"{words} {parts} {words} x"
    assert pages.main_text(f"{menu}<div>{half}{toc}</div>{menu}") == f"{words} {parts}"
    assert pages.main_text(f"<p>one two three<p><a href=/>linked</a> x<p>four") == "one two three linked x four"
    assert pages.main_text(f"{half}{menu}{half}<p>x") == f"{words} {words} x"
    assert pages.main_text("<div><article>one</article><p>-<article>two three</article></div><div><article>four</article></div>") == "one two three four"


def test_window_sums_surge_and_dive():
    rng = np.random.default_rng(12)
    for _ in range(200):
        w = [int(x) if rng.random() < 0.25 else 0 for x in rng.integers(1, 50, int(rng.integers(0, 60)))]
        sums = [sum(w[max(0, i - pages.WINDOW + 1):i + pages.WINDOW]) for i in range(len(w))]
        assert pages.window_sums(w) == sums
        spans_, at = [], 0
        while at < len(w):
            end = at
            while end < len(w) and sums[end] > 0:
                end += 1
            if end > at:
                inside = [k for k in range(at, end) if w[k]]
                spans_.append((inside[0], inside[-1]))
            at = end + 1
        assert pages.stretches(w) == spans_


def test_blocks_decide_without_marks():
    """Plain pages without article, main, classes or containers: sums alone tell text from a far-off list of links,
    and short lines between long ones stay."""
    menu = "".join(f"<p><a href=/{k}>no</a></p>" for k in range(9))
    body = "<h2>Title</h2>" + "<p>one two three four</p><p>- <a href=#>x</a></p>" * 4
    want = "Title" + " one two three four - x" * 4
    assert pages.main_text(f"<body>{menu}{body}{menu}</body>") == want
    assert pages.main_text(f"<div>{menu}</div><div>{body}</div><div>{menu}<p>no</p></div>") == want
    # an article of few words beside a long text does not win
    assert pages.main_text(f"<article>no</article>{menu}<div>{body}</div>") == want


def test_formulas_and_drawings_of_an_article_stay():
    inner = "<p>sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> and <svg><title>no</title><style>no</style><text>label</text></svg></p><noscript><p>table as text</p></noscript>"
    assert pages.main_text(f"<noscript>no</noscript><article>{inner}</article>") == "sum a+b and label table as text"
    assert pages.main_text(f"<noscript>no</noscript><div><p>text</p></div>") == "text"


def test_very_long_page():
    text = "word " * 400_000
    assert pages.main_text(f"<nav>no</nav><article><p>{text}</p></article>") == text.strip()


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 16))
    x = [list(map(float, b + rng.normal(size=16) * s)) for b in base for s in (0, 0, 0.05, 0.2, 0.45)]
    rows = [(i * 2, v) for i, v in enumerate(x)] + [(1001, None), (1003, []), (1005, [0.0] * 16), (1007, [float("nan")] * 16), (1009, [None] * 16), (1011, x[0][:8]), (1013, [float("inf")] + x[0][1:]), (0, x[0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("weight", F.lit(1)).repartition(4)
    u = np.array([np.array(v, np.float32).astype(float) for v in x + [x[0]]])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    ids = [i * 2 for i in range(len(x))] + [0]
    hit = u @ u.T >= 0.9
    part = brute.components(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if hit[i, j]])
    least = {p: min(ids[k] for k in range(len(ids)) if part[k] == p) for p in set(part)}
    expected = sorted([(ids[k], int(hit[k].sum() - 1), least[part[k]], ids[k] == least[part[k]]) for k in range(len(ids))] + [(i, 0, i, True) for i in range(1001, 1014, 2)])
    for tile in (4096, 20):
        assert sorted(map(tuple, vectors.near_vectors(df, tile=tile).collect())) == expected
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_at_the_threshold(spark):
    """Pairs whose cosine the bounds cannot tell from the threshold, and components of any size."""
    from fractions import Fraction

    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.9, 0.19 ** 0.5, 0.0]), (3, [0.9 - 1e-9, 0.19 ** 0.5, 0.0]), (4, [0.9 + 1e-9, 0.0, 0.19 ** 0.5]), (5, [1e-200, 0.0, 0.0]), (6, [1e200, 1e190, 0.0]), (7, [0.0, 0.0, 1.0])]

    def cosine(x, y):
        x, y = ([Fraction(v) for v in z] for z in (x, y))
        dot = sum(p * q for p, q in zip(x, y))
        return dot >= 0 and dot * dot * 100 * 100 >= 90 * 90 * sum(p * p for p in x) * sum(q * q for q in y)

    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for i, x in rows:
        sure = [j for j, y in rows if j != i and {i, j} not in ({1, 2}, {2, 5})]  # exactly at 0.9 but for rounding
        assert sum(cosine(x, dict(rows)[j]) for j in sure) <= got[i] <= sum(cosine(x, dict(rows)[j]) for j in sure) + len(rows) - 1 - len(sure)


def test_second_vectors_settle_nearly_all():
    rng = np.random.default_rng(8)
    x = rng.normal(size=64) + rng.normal(size=(300, 64)) * 0.33
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = vectors.quantise(x)
    r, f, left = vectors.quantise(x - q * s[:, None])
    rows = pa.table({"id": np.arange(300), "weight": np.ones(300, np.int64), "tile": np.zeros(300, np.int32), "q": [a.tobytes() + b.tobytes() for a, b in zip(q, r)],
                     "info": [np.array(v).tobytes() for v in zip(s, e, f, left)]})
    (ids, links, _), (i, j) = vectors.compare(rows, 64, True, 0.9)
    hit = x @ x.T >= 0.9
    np.fill_diagonal(hit, False)
    full = np.zeros(300, np.int64)
    full[ids] = links
    for a, b in zip(i, j):
        full[a] += hit[a, b]
        full[b] += hit[a, b]
    assert (full == hit.sum(1)).all() and hit.sum() > 10000 and len(i) < 0.01 * hit.sum()


def test_quantisation_bound_is_rigorous():
    rng = np.random.default_rng(6)
    for dim in (3, 64, 1500):
        x = rng.normal(size=(200, dim)) * rng.choice([1, 20], (200, dim), p=[0.95, 0.05])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        q, s, e = vectors.quantise(x)
        approx = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
        assert (np.abs(approx - x @ x.T) <= e[:, None] + e[None, :] * (1 + e[:, None]) + 1e-12).all()


@pytest.mark.parametrize("batch", [2000, 6 << 20])
def test_repeats(spark, make_docs, odd_rows, none, monkeypatch, batch):
    monkeypatch.setattr(spans, "BATCH", batch)
    rng = np.random.default_rng(8)
    passages = [prose(rng, int(n), 10**6) for n in rng.integers(8, 40, 12)]
    rows = list(odd_rows) + [(100 + i, " ".join([prose(rng, int(rng.integers(0, 60)), 10**6), passages[rng.integers(12)], prose(rng, int(rng.integers(0, 9)), 10**6), passages[rng.integers(12)]]), "p") for i in range(60)]
    docs = make_docs(rows, clash=True)
    got = spans.remove_repeats(docs)
    assert got.columns == [*docs.columns, "n_words", "n_removed"]
    expected = brute.repeat_removal([(i, t) for i, t, _ in rows])
    left = Counter((i, *expected[i, t]) for i, t, _ in rows)
    assert Counter(map(tuple, got.select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect())) == left
    assert spans.remove_repeats(none).count() == 0


def test_batches_of_repeats_keep_their_order(spark, make_docs, odd_rows, monkeypatch):
    """Rows reach the numbered batches sorted, also where the join does not sort."""
    seen = {}
    real = spans.candidates
    monkeypatch.setattr(spans, "candidates", lambda found, *rest: real(seen.setdefault("found", found), *rest))
    spans.remove_repeats(make_docs(odd_rows).select("doc_id", "text"))
    for part in seen["found"].select("_key", "_text_key", F.spark_partition_id().alias("p")).toPandas().groupby("p"):
        rows = list(zip(part[1]["_key"], part[1]["_text_key"]))
        assert rows == sorted(rows)


def test_repeats_keep_layout_of_what_stays(spark, make_docs):
    part = " ".join(f"p{i}" for i in range(20))
    got = spans.remove_repeats(make_docs([(1, "a\n" + part + "\n z", "s"), (2, " b\tc\n" + part + "\n\nd  e ", "s"), (3, part, "s")]), tidy=False)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "a\n" + part + "\n z", 2: " b\tc\nd  e ", 3: ""}


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(500)] + [(5000, 5000), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(500)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_digest_of_ids():
    assert crc_of_ids(np.array([1, 2], "<u4")) == zlib.crc32(struct.pack("<2I", 1, 2))
