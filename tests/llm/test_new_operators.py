"""Alignment of tokenizers, whitening and tokeniser fertility against plain versions of themselves, on whole small tables and on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from vitrine.llm import alignment, bpe, fertility, secrets, units, whitening
from vitrine.llm.queries import QUERIES

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
RANKS = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
NOISE = ["a", "The ", "  ", "\n", " ", "<|endoftext|>", "é", "É", "ΑΣ", "'s", "'LL", "1", "22", "!!", "中", "😀", "x" * 30, "\x1c", "　", "ing", "̀", "ﬁ", "▁", "<0x41>", "<s>", "\t", "᠎ ",
         "​ ", "\x85 ", "\xa0 ", "\x00", "-", "ß"]


def noise(seed, n=30):
    r = random.Random(seed)
    return "".join(r.choice(NOISE) for _ in range(r.randint(1, n)))


# ---- alignment ----


class Plain:
    """Both libraries on whole texts, and groups by going through the bytes."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def tokens(self, text):
        """(ids, bytes) of A and B, empty where they don't spell the text."""
        if not text:
            return ([], []), ([], [])
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        bytes_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + text).encode()
        return ((a, bytes_a), (b, bytes_b)) if b"".join(bytes_a) == whole == b"".join(bytes_b) else (([], []), ([], []))

    def groups(self, text):
        (a, bytes_a), (b, bytes_b) = self.tokens(text)
        ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        out, before = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            out.append(([i for i, e in zip(a, ends_a) if before < e <= end], [i for i, e in zip(b, ends_b) if before < e <= end]))
            before = end
        return out

    def rows(self, texts):
        found = {i: self.groups(t) for i, t in texts.items()}
        links = {i: Counter((x, y) for ga, gb in g for x in ga for y in gb) for i, g in found.items()}
        counts = Counter(p for link in links.values() for p in link)
        best = {}
        for (x, _), n in counts.items():
            best[x] = max(best.get(x, 0), n)
        for i, g in found.items():
            shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
            n = links[i]
            yield (i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(n.values()), sum(k for p, k in n.items() if counts[p] == best[p[0]]),
                   sum(k * counts[p] for p, k in n.items()), hashlib.sha256(shown.encode()).hexdigest() if g else "")


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def collected(df, columns=COLUMNS):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_alignment_of_whole_documents(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert collected(QUERIES["op11_token_alignment"](spark, small)) == sorted(Plain().rows(texts))


def test_alignment_of_noise_and_copies(spark, monkeypatch):
    texts = {i: noise(i // 2 if i < 60 else i) for i in range(200)} | {200: None, 201: "", 202: " ", 203: "a ", 204: "\U0001f600" * 400, 205: "foo  bar " * 50}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = sorted(Plain().rows(texts))
    assert 0 < sum(w[1] == 0 for w in want) < 150
    assert collected(alignment.align_tokens(docs, A, B)) == want
    monkeypatch.setattr(alignment, "PAIRS_PER_BLOCK", 100)
    assert collected(alignment.align_tokens(docs, A, B)) == want


@pytest.mark.parametrize("large", [1, 1 << 12])
def test_groups_and_links_of_one_text(monkeypatch, large):
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    tokens, plain = units.both(A, B), Plain()
    encoded = units.Encoded(tokens)
    for k in range(0, 400, 8):
        texts = [noise(k + i) for i in range(8)]
        found = alignment.Alignment(tokens, texts, encoded.of(texts))
        starts, pairs, often = found.links()
        for i, text in enumerate(texts):
            groups = plain.groups(text)
            assert found.groups(i) == groups
            links = Counter(x * tokens.size_b + y for ga, gb in groups for x in ga for y in gb)
            assert dict(zip(pairs[starts[i] : starts[i + 1]].tolist(), often[starts[i] : starts[i + 1]].tolist())) == links


def test_pair_counts_are_documents_not_texts(spark):
    docs = spark.createDataFrame([(i, "one two") for i in range(7)] + [(7, "two one one")], "doc_id long, text string")
    counts = alignment.pair_counts(alignment.align_distinct(docs, A, B), units.both(A, B).size_b)
    assert sorted(r["n"] for r in counts.collect()) == [8, 8] and counts.where("best").count() == 2


def test_parts_are_encoded_as_in_place(monkeypatch):
    for path in (A, RANKS):
        tokens = units.both(path, B)
        assert tokens.cuttable
        for k in range(1500):
            text = noise(k, 40)
            a, b = tokens.a.encode([" " + text])[0], tokens.b.encode(text)
            found = list(tokens.encode(tokens.parts(text)))
            assert [i for ids, _ in found for i in ids] == a and [i for _, ids in found for i in ids] == b
    encoded = units.Encoded(tokens)
    texts = [noise(k, 60) for k in range(50)]
    want = [x.tolist() for side in encoded.of(texts) for x in side]
    monkeypatch.setattr(units, "REMEMBERED", 0)  # what is forgotten is encoded again
    again = units.Encoded(tokens)
    for _ in range(3):
        assert [x.tolist() for side in again.of(texts) for x in side] == want


def test_alignment_of_odd_rows(odd, none):
    found = alignment.align_tokens(odd.withColumnRenamed("n_words", "N_Links"), A, B)
    assert found.count() == odd.count() and found.columns == ["doc_id", "text", "score", *alignment.RESULTS]
    assert found.where("text is null or text = ''").agg(F.sum("n_a"), F.max("groups_sha256")).first()[:] == (0, "")
    assert alignment.align_tokens(none, A, B).count() == 0
    with pytest.raises(ValueError):
        alignment.align_tokens(odd.withColumnRenamed("text", "n_a"), A, B, text="n_a")


# ---- whitening ----


def direct(vectors, k=8):
    """Everything from the covariance written out, and from exact numbers where they are asked for."""
    good = {i: v for i, v in vectors.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    x = {i: [math.floor(1024 * float(c)) + 100000 for c in v] for i, v in good.items()}
    n, sums = len(x), [sum(c) for c in zip(*x.values())]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x.values()])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return deviation, values, axes, dict(zip(x, centred @ axes / np.sqrt(values))), values / np.trace(centred.T @ centred / n)


def test_whitening_of_whole_embeddings(spark, small):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}
    deviation, values, _, whitened, explained = direct(vectors)
    got = QUERIES["op12_whitening"](spark, small).collect()
    assert len(got) == 8 * len(vectors) and {r["n"] for r in got} == {len(vectors)}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-12
    w = np.zeros((len(vectors), 8))
    place = {i: k for k, i in enumerate(whitened)}
    for r in got:
        assert r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-12)
        w[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    want = np.array(list(whitened.values()))
    signs = np.sign((w * want).sum(0))
    assert np.abs(w * signs - want).max() < 1e-8


def test_eigenpairs_of_many_shapes():
    r = np.random.default_rng(1)
    q = np.linalg.qr(r.standard_normal((300, 300)))[0]
    spectra = [np.r_[5, 5, 5, 5, np.ones(6), np.zeros(290)], 1 / np.arange(1, 301.0) ** 2, np.r_[1e6, 1e-3 * r.random(299)], 1 + 1e-9 * r.random(300), r.random(300) + 1]
    matrices = [q @ np.diag(s) @ q.T for s in spectra]
    matrices += [a @ a.T for d in (1, 2, 7, 8, 9, 30, 150) for a in [r.standard_normal((d, d + 3))]]
    for m in matrices:
        m = (m + m.T) / 2
        values, vectors, norms = whitening.leading(lambda z, m=m: m @ z, len(m))
        exact = np.linalg.eigvalsh(m)[::-1][: len(values)]
        assert len(values) == min(8, len(m)) and np.abs(values - exact).max() <= 1e-12 * exact[0] and norms.max() <= 1e-11 * exact[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_corrections_solve_their_equations():
    r = np.random.default_rng(2)
    m = r.standard_normal((40, 40))
    m = m @ m.T
    e, s = np.linalg.eigh(m)
    u = np.linalg.qr(s[:, -3:] + 0.01 * r.standard_normal((40, 3)))[0]
    values = np.diag(u.T @ m @ u)
    residuals = m @ u - u * values
    t = whitening.corrections(lambda z: m @ z, u, values, residuals, 80)
    clear = np.eye(40) - u @ u.T
    for k in range(3):
        assert np.linalg.norm(clear @ (m - values[k] * np.eye(40)) @ clear @ t[:, k] + clear @ residuals[:, k]) < 1e-6 * np.linalg.norm(residuals[:, k]) + 1e-9
    assert np.abs(u.T @ t).max() < 1e-10


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("Whitened", T.StringType())])


def test_whitening_of_odd_rows(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(5).tolist(), "x") for i in range(40)] + [(7, r.standard_normal(5).tolist(), None)] * 2 + [(None, r.standard_normal(5).tolist(), "x")]
    bad = [(90, None, "x"), (91, [], "x"), (92, [1.0, None, 1.0, 1.0, 1.0], "x"), (93, [math.nan] * 5, "x"), (94, [math.inf] * 5, "x"), (95, [1e300] * 5, "x"), (96, [1.0, 2.0], "x")]
    got = whitening.whiten(spark.createDataFrame(rows + bad, VECTORS)).collect()
    assert len(got) == 5 * 43 and {r["n"] for r in got} == {43} and sum(r["vec_id"] == 7 for r in got) == 15 and sum(r["vec_id"] is None for r in got) == 5
    assert sum({r["component"]: r["explained"] for r in got}.values()) == pytest.approx(1) and got[0]["identity_error"] < 1e-12
    frame = lambda rows: spark.createDataFrame(rows, VECTORS)
    for none in ([], [(1, [1.0, 2.0], "x")], [(i, [1.0, 2.0], "x") for i in range(5)], bad[:2]):
        assert whitening.whiten(frame(none)).count() == 0
    two = whitening.whiten(frame([(0, [0.0, 0.0, 0.0], "x"), (1, [1.0, 2.0, 2.0], "x")])).collect()  # one direction
    assert [(r["component"], round(abs(r["whitened"]), 9), r["explained"]) for r in two] == [(1, 1.0, pytest.approx(1))] * 2


def test_large_deviations_are_exact():
    x = np.array([[1 << 40, 3], [5, -(1 << 52)], [1, 2]], np.int64)
    sums = x.sum(0)
    want = [sum((3 * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in x.tolist()]
    assert whitening.deviations(x, 3, sums).to_pylist() == [w if w < 1 << 63 else None for w in want]
    assert whitening.deviations(x[2:], 1, x[2]).to_pylist() == [0]


# ---- fertility ----


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = text.split("\n")
    again = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)


def test_counts_and_measures_of_whole_documents(spark, small):
    import tiktoken

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    ranks = units.ByRanks(RANKS).library
    assert isinstance(ranks, tiktoken.Encoding)
    got = QUERIES["op13_fertility"](spark, small).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]]
        counts = plain_counts(text)
        assert tuple(r[c] for c in fertility.COUNTS) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["base_failed"] and r["kept"])
        if text:
            b = pieces.encode(text)
            p = np.array(list(Counter(b).values())) / len(b)
            want = (len(text) / len(ranks.encode_ordinary(" " + text)), len(text) / len(b), sum(pieces.is_byte(i) for i in b) / len(b), -(p * np.log2(p)).sum())
            assert tuple(r[m] for m in fertility.MEASURES) == pytest.approx(want, abs=6e-4)


def test_noise_is_counted_as_plainly():
    parts = ["a", "b", " ", " ", "\n", "a b c ", "#", "\t", "\x1c", "\xa0", "é"]
    for k in range(500):
        r = random.Random(k)
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 60)))
        assert fertility.base_counts(text) == plain_counts(text)


def prose(k, words=120, unit="worten{}"):
    r = random.Random(k)
    return " ".join(unit.format("abcdefgh"[r.randint(0, 7)] * r.randint(1, 3)) + str(r.randint(0, 999)) for _ in range(words))


def test_bands_reject_what_does_not_fit_its_group(spark):
    rows = [(i, prose(i), "en") for i in range(60)] + [(100, " ".join(chr(0x4E00 + (i * 37) % 900) for i in range(120)), "en"), (101, " ".join("x\U0001f9ff" * 3 + str(i) for i in range(120)), "en"),
            (102, prose(1, unit="W#O#R#T!!{}"), "en"), (103, "short text", "en"), (104, " ".join(["same words here"] * 40), "en"), (105, prose(999), None), (106, None, "en")]
    rows += [(200 + i, rows[0][1], "en") for i in range(300)]  # copies don't decide
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in fertility.keep(docs, RANKS, B, language="lang").collect()}
    assert len(got) == len(rows) and sum(got[i]["kept"] for i in range(60)) >= 59 and all(got[200 + i]["kept"] == got[0]["kept"] for i in range(300))
    assert not any(got[i]["kept"] for i in (101, 102, 103, 104, 106)) and got[105]["kept"]
    assert got[100]["script"] == "han" and got[100]["kept"]  # no band of its own, so no reason to reject
    assert [got[i]["base_failed"] for i in (101, 102, 103, 104, 106)] == [False, False, True, True, True]


def test_bands_are_quartiles_of_distinct_measures(spark):
    values = [(1.0 + i / 100, 2.0, 0.0, 5.0) for i in range(41)]
    rows = [("latin", 7, False, *v) for v in values for _ in range(3)]
    names = ["script", "size_class", "base_failed", *fertility.MEASURES]
    limits = fertility.bands(spark.createDataFrame(rows, names)).where("size_class = 7").first()
    q = np.quantile([v[0] for v in values], [0.25, 0.75])
    assert limits["members"] == 41
    assert (limits["low_chars_per_token_a"], limits["high_chars_per_token_a"]) == pytest.approx((q[0] - 3 * (q[1] - q[0]), q[1] + 3 * (q[1] - q[0])))
    assert (limits["low_fallback_share"], limits["high_fallback_share"]) == pytest.approx((-0.03, 0.03))


def test_scripts():
    for text, script in (("", ""), ("12 !", ""), ("abc", "latin"), ("déjà", "latin"), ("привет x", "cyrillic"), ("中文 ok", "han"), ("ひらがな中", "kana"), ("한국어", "hangul"), ("ab中文", "han"),
                         ("שלום", "hebrew"), ("مرحبا", "arabic"), ("αβγ", "greek"), ("\U00020000a\U00020001", "han")):
        assert fertility.script_of(text) == script


def test_fertility_of_odd_rows(odd, none):
    for language in (None, "doc_id"):
        found = fertility.keep(odd.withColumnRenamed("score", "Kept"), RANKS, B, language=language)
        assert found.count() == odd.count() and {"n_words", "kept", "doc_id"} <= set(found.columns) and "Kept" not in found.columns
        assert found.where("n_words = 0 and kept").count() == 0
        assert fertility.keep(none, RANKS, B, language=language).count() == 0
    with pytest.raises(ValueError):
        fertility.keep(odd, RANKS, B, text="text", language="n_words")


# ---- words by the transducer, at once and symbol by symbol ----


def test_words_at_once_are_words_symbol_by_symbol():
    coder = bpe.coder(str(public_tokenizers.path("word_bpe_49k.json")))
    machine, r = bpe.Transducer(coder.merges), random.Random(8)
    for _ in range(3000):
        word = "".join(r.choice("abcdeinorstth") for _ in range(r.randint(1, 20)))
        whole = machine.word(word)
        assert whole == machine.feed(word[:-1]) + machine.close(word[-1]) and (machine.text, machine.last, machine.start) == ("", [], [])


def test_slices_change_nothing(monkeypatch):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    worker = bpe.digests(path)
    texts = [noise(k, 80) for k in range(60)]
    want = [worker.of(t) for t in texts]
    monkeypatch.setattr(bpe, "CHUNK", 7)
    assert [worker.of(t) for t in texts] == want
    kept: list = []
    assert worker.of(texts[0], kept)[0] == len(kept) and kept == Tokenizer.from_file(path).encode(texts[0], add_special_tokens=False).ids


# ---- secrets: costs and spans by trying everything ----


def every_segmentation(value, words):
    """The least cost over all ways to cut a value, by trying them all."""
    ranks, longest = secrets._ranks(words)
    n, lower, brute = len(value), value.lower(), math.log10(secrets._alphabet(value))

    def segment(i, j):
        costs = [brute * (j - i), secrets.segment_cost(value, i, j, brute, ranks, longest)]
        costs += [brute * u + math.log10((j - i) // u) for u in secrets.REPEATED if j - i >= 3 * u and (j - i) % u == 0 and lower[i:j] == lower[i : i + u] * ((j - i) // u)]
        return min(costs) + (0.3 if i else 0.0)

    def ways(i):
        if i == n:
            yield 0.0
        for j in range(i + 1, n + 1):
            yield from (segment(i, j) + rest for rest in ways(j))

    least = min(ways(0))
    periods = [p for p in range(1, n // 2 + 1) if lower[p:] == lower[: n - p]]
    return min([least] + [every_segmentation(value[:p], words) + math.log10(-(-n // p)) for p in periods[:1]])


def test_costs_are_the_least_over_all_segmentations():
    words = tuple("pass word abc cat dog the".split())
    parts = ["a", "a", "b", "1", "-", "pass", "Cat", "d0g", "qwe", "2020", "aa", "x", ".", "www."]
    for k in range(250):
        r = random.Random(k)
        value = "".join(r.choice(parts) for _ in range(r.randint(1, 7)))[:11]
        assert secrets.guess_cost(value, words) == pytest.approx(every_segmentation(value, words), abs=1e-9), value


def test_long_and_ordinary_values_are_no_secrets():
    found = lambda t: [k for _, _, k in secrets.spans_of(t)]
    for text in ("pwd: " + "-" * 100, "pwd: " + "-" * 400, "pwd: " + "*" * 600, "pwd: " + "password" * 10, "pwd: " + "password" * 60, "login: https://www.example.com/login",
                 "auth: user@example.org", "authorization: required-by-law", "auth: two-factor-authentication", "login: https://www.example.org/login?next=/index.html", "pwd: " + "-=" * 3000):
        assert found(text) == [], text
    r = random.Random(4)
    long = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP0123456789!$") for _ in range(2999)) + "z"
    assert found("pwd: " + long) == ["guess"] and secrets.spans_of("pwd: " + long)[0][:2] == (5, 3005)


def test_planted_secrets_are_found():
    r, hit = random.Random(9), 0
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(300):
        signs = r.choice([letters + "0123456789", letters + letters.upper() + "0123456789", letters + letters.upper() + "0123456789!$%^&*"])
        value = "".join(r.choice(signs) for _ in range(r.randint(10, 20)))
        text = f"{r.choice(['login: ', 'pwd = ', 'passcode is ', 'Authorization: Bearer ', 'private_key='])}{value} and more"
        start = text.index(value)
        hit += any(a <= start and start + len(value.rstrip("!$%^&*")) <= b for a, b, _ in secrets.spans_of(text))
    assert hit >= 297


def test_spans_of_whole_documents(spark, small):
    """Base spans by trying every place of every text."""
    def plain(text):
        out, patterns = [], (("assign", r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 1), ("access", "(AKIA[A-Z0-9]+)", 20, 1), ("hex", "([0-9a-f]+)", 24, 1))
        for kind, pattern, least, group in patterns:
            compiled, at = re.compile(pattern, re.A | (re.I if kind == "assign" else 0)), 0
            while at < len(text):
                m = compiled.match(text, at)
                if m:
                    if len(m[group]) >= least:
                        out.append((m.start(), kind, m.end()))
                    at = m.end()
                else:
                    at += 1
        return out

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    order = ["assign", "access", "hex"]
    for r in QUERIES["op4_secrets"](spark, small).collect():
        want = sorted(plain(texts[r["doc_id"]]), key=lambda s: (s[0], order.index(s[1])))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == kind for _, k, _ in want) for kind in order)
