import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import prose, words

import __spark_entry__ as E
from exonloom.llm import align, language, queries, runs, tokens
from exonloom.llm.common import row_spans
from exonloom.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def crc(i):
    return zlib.crc32(str(i).encode())


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def runs_by_hand(w, least=6, times=4):
    """Maximal stretches with a least period, from every pair of a start and a period."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                s = w[i:j + q]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(i, text):
    w = words(text)
    h = 1 if i is None else crc(i)
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
    return w


def runs_row(i, text):
    w = planted(i, text)
    found = runs_by_hand(w)
    best = None
    for s, n, q in found:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    shape = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (i, len(found), *shape, digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(x for k, x in enumerate(w) if k not in gone)), len(w))


def periodic(rng, n):
    """Words with runs of many periods, also nested and overlapping ones."""
    w = []
    while len(w) < n:
        part = [f"p{rng.integers(3)}" for _ in range(int(rng.integers(1, 7)))]
        w += part * int(rng.integers(1, 9)) + part[:int(rng.integers(0, len(part)))] + [f"x{rng.integers(40)}"] * int(rng.integers(0, 2))
    return w


@pytest.mark.parametrize("times", [3, 4, 6])
def test_runs_of_words(times):
    rng = np.random.default_rng(times)
    texts = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 9 + ["a"], ["a"] * 40] + [periodic(rng, int(rng.integers(1, 90))) for _ in range(300)]
    texts += [list(map(str, rng.integers(0, 2, 60))) for _ in range(200)]
    flat, numbers = [w for t in texts for w in t], {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in flat])
    first = np.cumsum([0] + [len(t) for t in texts])
    got = defaultdict(list)
    for k, s, n, q in runs.find_runs(ids, first, 6, times).tolist():
        got[k].append((s, n, q))
    for k, t in enumerate(texts):
        assert got[k] == runs_by_hand(t, 6, times)
    with pytest.raises(ValueError):
        runs.find_runs(ids, first, 6, 2)


def test_factor_runs_query(spark, make_docs, odd_rows, none, tmp_path):
    rng = np.random.default_rng(21)
    rows = list(odd_rows) + [(300 + i, " ".join(periodic(rng, 80)), "r") for i in range(60)] + [(500, "a b\n" * 4000, "r"), (501, "q " * 3, None)]
    make_docs(rows, clash=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(map(tuple, queries.factor_runs(spark, str(tmp_path)).collect()))
    assert got == Counter(runs_row(i, t) for i, t, _ in rows)
    assert sum(n > 0 for _, n, *_ in got) > 30
    none.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.factor_runs(spark, str(tmp_path / "none")).count() == 0


def test_collapse_keeps_columns(make_docs):
    docs = make_docs([(1, "x " + "a b c " * 5 + "y", "s"), (2, None, None), (2, None, None)], clash=True).withColumn("runs", F.lit("clash"))
    out = runs.collapse(docs)
    assert out.columns == [c for c in docs.columns if c != "runs"] + ["n_words", "runs"]
    rows = sorted((r["doc_id"], r["text"], r["n_words"], [tuple(x) for x in r["runs"]]) for r in out.collect())
    assert rows == [(1, "x a b c y", 17, [(1, 15, 3)]), (2, "", 0, []), (2, "", 0, [])]


def test_factor_runs_on_given_documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r["text"]) < 2500]
    got = {r["doc_id"]: tuple(r) for r in E.queries()["op11_factor_runs"](spark, FOLDER).collect()}
    assert len(got) == len(rows) and all(got[r["doc_id"]] == runs_row(*r) for r in short)


def test_row_spans():
    column = pa.array(["aaaa", None, "é", "bb", "c" * 50, "", "d"])
    assert list(row_spans(column, 6)) == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert list(row_spans(column.slice(3), 3)) == [(0, 1), (1, 2), (2, 4)] and list(row_spans(column.slice(0, 0), 3)) == []


def test_codewords_stand_apart():
    for n in (1, 2, 3, 4, 5, 6, 20, 90):
        code = language.codewords(n)
        assert len(code) == n and set(np.unique(code)) <= {-1, 1}
        assert len({c.tobytes() for c in code}) == n if n > 1 else code.shape[1] == 0
        assert all(abs(c.sum()) < n for c in code.T) and (language.codewords(n) == code).all()
        if n > 3:
            assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 3


def test_language_margins_by_hand():
    rng = np.random.default_rng(3)
    model = language.Model(["a", "b"], language.codewords(2), rng.normal(size=(language.FEATURES, 1)).astype(np.float32), np.ones(1), np.zeros(1), np.ones(1))
    texts = ["Äb, c!", "", None, "x" * 40000, "1 2", "one two  THREE"]
    shown = [" äb c ", " ", " ", " " + "x" * 40000 + " ", " ", " one two three "]
    for got, s in zip(model.margins(texts), shown):
        b = np.frombuffer(s.encode(), np.uint8)
        each = [model.weights[language.grams(b[k:k + n], n)[0], 0] for n in language.ORDERS for k in range(len(b) - n + 1)]
        assert math.isclose(got[0], np.mean(each) if each else 0, rel_tol=1e-4, abs_tol=1e-6)


def test_gram_counts_by_hand(make_docs):
    texts = ["ab cd", "ab", "x", "", "ab cd"]
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    expected = Counter(int(language.grams(np.frombuffer(f" {t} ".encode() if t else b" ", np.uint8), n)[k]) for t in texts for n in language.ORDERS for k in range((len(t) + 2 if t else 1) - n + 1))
    assert {r["feature"]: r["n"] for r in language.gram_counts(docs, "lang", "text").collect()} == dict(expected)


def test_language_of_odd_texts(spark, make_docs, odd, none):
    model = language.train(make_docs([(i, prose(np.random.default_rng(i), 30), "s") for i in range(9)] + [(50, "zz zz zz", "s")]))
    out = language.identify(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score", "ambiguous"]
    for r in out.select("text", "lang_pred", "score").collect():
        spoken = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"], r["score"]) == (("en", 1.0) if spoken else ("und", 0.0))
    assert language.train(none) is None and language.train(odd.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {tuple(r) for r in language.identify(odd, None).select("lang_pred", "score", "ambiguous").collect()} == {("und", 0.0, True)}
    assert language.identify(none, model).count() == 0


@pytest.fixture(scope="module")
def odd(make_docs, odd_rows):
    return make_docs(odd_rows, clash=True)


@pytest.fixture(scope="module")
def none(make_docs):
    return make_docs([])


def test_language_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", F.regexp_count("text", F.lit(r"\p{L}+")).alias("n"))
    got = E.queries()["op12_output_codes"](spark, folder).join(docs, "doc_id").toPandas()
    assert len(got) == docs.count() and (got.held_out == [crc(i) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out & (got.n >= 3)]
    assert (held.lang == held.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()
    assert got[got.lang == got.lang_pred].score.mean() > got[got.lang != got.lang_pred].score.mean() or (got.lang == got.lang_pred).all()


def test_many_languages_with_a_hot_one(spark):
    rng = np.random.default_rng(8)
    alphabets = ["".join(rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))[:9]) for _ in range(12)]
    text = lambda k: " ".join("".join(rng.choice(list(alphabets[k]), 5)) for _ in range(25))
    rows = [(i, text(k), f"l{k:02}") for i, k in enumerate([*np.repeat(np.arange(12), 20), *[0] * 500])]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    test = spark.createDataFrame([(f"l{k:02}", text(k)) for k in range(12) for _ in range(10)], "truth string, text string")
    got = language.identify(test, model).toPandas()
    assert len(model.languages) == 12 and (got.truth == got.lang_pred).mean() > 0.97


def align_by_hand(rows):
    """{row: contract values} by bytes owned by tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    shown = tokens.shown_bytes()
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    per_doc = []
    for _, text in rows:
        groups, links = [], []
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            spell_a = [bytes(shown[c] for c in a.id_to_token(i)) for i in ids_a]
            spell_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
                own_a, own_b = ([k for k, x in enumerate(spell) for _ in x] for spell in (spell_a, spell_b))
                links = [(ids_a[i], ids_b[j]) for i, j in sorted(set(zip(own_a, own_b)))]
                end_a, end_b = (list(np.cumsum([len(x) for x in spell])) for spell in (spell_a, spell_b))
                i = j = 0
                for e in sorted(set(end_a) & set(end_b)):
                    x, y = end_a.index(e) + 1, end_b.index(e) + 1
                    groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
                    i, j = x, y
                per_doc.append((len(ids_a), len(ids_b), groups, links))
                continue
        per_doc.append((0, 0, [], []))
    counts = Counter(p for *_, links in per_doc for p in set(links))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return Counter((i, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), digest(";".join(groups)) if groups else "")
                   for (i, _), (n_a, n_b, groups, links) in zip(rows, per_doc))


@pytest.mark.parametrize("batch,together", [(4 << 20, 4096), (3000, 2)])
def test_alignment(spark, make_docs, odd_rows, none, tmp_path, monkeypatch, batch, together):
    monkeypatch.setattr(align, "BATCH", batch)
    monkeypatch.setattr(align, "TOGETHER", together)
    monkeypatch.setattr(align, "REMEMBERED", 20000)
    rows = [(i, t[:5000] if t else t, s) for i, t, s in odd_rows]
    rows += [(600, "a<|endoftext|>b <s> </s><unk> x", "s"), (601, " lead", "s"), (602, "tail  \n\n", "s"), (603, "日本語のテキスト、続く", "s"), (604, "a\0b", "s"), (605, "▁x ▁", "s"), (606, "naïve café ﬁ", "s"), (607, "\n", "s"), (607, "\n", "s")]
    rows += [(700 + r["doc_id"], r["text"], "s") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect() if len(r["text"]) < 4000]
    docs = make_docs(rows, clash=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(map(tuple, queries.anchor_windows(spark, str(tmp_path)).collect()))
    assert got == align_by_hand([(i, t) for i, t, _ in rows])
    full = align.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    assert Counter(digest(r["groups"]) if r["groups"] else "" for r in full.collect()) == Counter(x[-1] for x in got.elements())
    none.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.anchor_windows(spark, str(tmp_path / "none")).count() == 0


def test_windows_are_remembered():
    known = align.Tokenizers(tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    align.align_texts(known, ["one two three", "three two one one one", "two"])
    assert len(known.groups) == 3
    with pytest.raises(ValueError):
        tokens.Encoder(tokenizer_path("word_bpe_49k.json")).id_bytes()
