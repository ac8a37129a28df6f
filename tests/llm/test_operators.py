"""Each operator against a plain version of itself, on whole small tables and on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import oracle
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitrine.llm import bpe, class_lm, decontaminate, graph, jaccard, quality, secrets, substrings, suffixes, token_counts, top_k, toxicity
from vitrine.llm.queries import CHECKS, QUERIES

BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))
WORDS = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def documents(spark, small):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, small, name):
    assert oracle.compare(QUERIES[name](spark, small), oracle.connect(small), CHECKS[name]) is None


# ---- decontamination ----


def test_windows_of_all_lengths(spark):
    items = spark.createDataFrame([("b", "Alpha beta"), ("a", "alpha BETA!"), ("c", " ".join(map(str, range(12)))), ("d", None), ("e", "-")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "x alpha, beta y alpha"), (2, " ".join(map(str, range(1, 12)))), (3, None), (4, "beta alpha")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.find_contamination(docs, items).collect()}
    assert got == {1: (5, 2, ["a", "b"]), 2: (11, 11, ["c"]), 3: (0, 0, []), 4: (2, 0, [])}


def test_many_blocks_find_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"z a{i} b{i} c{i} a{i + 1} b{i + 1} c{i + 1}") for i in range(30)], "doc_id long, text string")
    one = sorted(map(str, decontaminate.find_contamination(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "PATTERNS_PER_BLOCK", 9)
    assert sorted(map(str, decontaminate.find_contamination(docs, items).collect())) == one


def test_contamination_of_odd_rows(odd, none, spark):
    items = spark.createDataFrame([(1, "the lazy dog"), (1, None)], "item_id long, text string")
    found = decontaminate.find_contamination(odd, items)
    assert found.count() == odd.count() and found.where("contaminated").count() == 3
    assert decontaminate.find_contamination(none, items).count() == 0
    assert decontaminate.find_contamination(odd, items.where("false")).where("contaminated").count() == 0
    assert decontaminate.clean_documents(odd, items).columns == odd.columns


# ---- tokens ----


def _noise(seed, n):
    r = random.Random(seed)
    parts = ["a", "The ", "  ", "\n", "<|endoftext|>", "<|endof", "<|startoftext|>", "é", "É", "ΑΣ", "İ", "'s", "'LL", "1", "22", "!!", "中", "x" * 30, "\x1c", "　", "ing", "̀", "ﬁ"]
    return "".join(r.choice(parts) for _ in range(n))


def test_counts_are_the_library_s(spark, small, documents, odd, none):
    library = Tokenizer.from_file(BYTES)
    want = {i: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in documents.items()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in QUERIES["op3_token_counts"](spark, small).collect()} == want
    for k in range(200):
        text = _noise(k, 60)
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert token_counts.counts(BYTES, [text]) == [n]
        assert token_counts.count(BYTES, text, chunk=random.Random(k).choice([20, 33, 64]), overlap=4) == n
    assert token_counts.count(BYTES, "a" * 3000, chunk=100, overlap=8) == len(library.encode("a" * 3000, add_special_tokens=False).ids)
    got = token_counts.count_tokens(odd, BYTES).collect()
    assert len(got) == 12 and all(r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in got)
    assert token_counts.count_tokens(none, BYTES).count() == 0


def test_round_trip_is_the_library_s(spark, small, documents, odd, none):
    library = Tokenizer.from_file(WORDS)

    def want(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))

    rows = QUERIES["op5_bpe_round_trip"](spark, small).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == {i: want(t) for i, t in documents.items()}
    for r in bpe.round_trip(odd, WORDS).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want(r["text"])
    assert bpe.round_trip(none, WORDS).count() == 0
    coder = bpe.coder(WORDS)
    for k in range(200):
        assert coder.ids(_noise(k, 40)) == library.encode(_noise(k, 40), add_special_tokens=False).ids
    for text in ("a" * 3000, "ha" * 2000, "-=" * 1500, "".join(random.Random(1).choice("abcdefinorst") for _ in range(4000))):
        assert coder.ids(text) == library.encode(text, add_special_tokens=False).ids


def test_transducer_keeps_little():
    machine = bpe.Transducer(bpe.coder(WORDS).merges)
    for _ in range(50):
        machine.feed("abcde" * 100)
        assert len(machine.text) < 8 * machine.merges.lookahead


def test_decoder_holds_back_incomplete_characters():
    coder = bpe.coder(WORDS)
    ids = coder.ids("naïve 中文 \U0001f600 end")
    assert bpe.Decoder(coder).text(ids) == "naïve 中文 \U0001f600 end "
    machine = bpe.Decoder(coder)
    assert "�" not in "".join(map(machine.feed, ids))


# ---- secrets ----


def test_base_spans():
    text = 'Password="abcdef" token:token:abcdefg api_key = x1 AKIA' + "A" * 16 + " AKIAABC " + "0f" * 12 + " secret=AKIA" + "B" * 16
    found = secrets.base_spans(text)
    assert [(text[a:b], k) for a, b, k in sorted(found)] == [
        ('Password="abcdef', "assign"), ("AKIA" + "A" * 16, "access"), ("0f" * 12, "hex"), ("secret=AKIA" + "B" * 16, "assign"), ("AKIA" + "B" * 16, "access"),
    ]
    assert secrets.base_spans("ſecret: abcdefgh") == []


def test_guess_cost_prefers_structure():
    cost = secrets.guess_cost
    assert cost("password") < 2 and cost("P4ssw0rd") < 4 and cost("qwertyuiop") < 4 and cost("2019-12-31") < 6 and cost("abcabcabc") < 6
    assert cost("x9$Kq2!vRz7m") > 12 and cost("aaaaaaaaaaaa") < 4
    kinds = lambda t: [k for _, _, k in secrets.spans_of(t)]
    assert kinds("pwd: x9$Kq2!vRz7m") == ["guess"] and kinds("pwd: changeme1") == [] and kinds("bearer of the news") == []


def test_guesses_after_all_credential_words():
    found = lambda t: [(t[a:b], k) for a, b, k in secrets.spans_of(t)]
    for before, value, after in (
        ("password: ", "x9$Kq2!vRz7m", ""), ("token = ", "p@55!kd93$Xq", ", and"), ("password is ", "Tr0ub4dor&3x", "."), ('{"API-Key":"', "x9$Kq2!vRz7m", '","b":1}'),
        ("DB_PASSWD=", "x9$Kq2!vRz7m", ""), ("clientSecret: '", "x9$Kq2!vRz7m", "'###"),
    ):
        assert found(before + value + after) == [(value, "guess")], before
    assert found("password=abc123!$Xy99 x") == [("password=abc123", "assign"), ("abc123!$Xy99", "guess")]
    assert found("password=hunter22x") == [("password=hunter22x", "assign")] and found("password is required") == []
    assert found('token = "ab8ca1b325bc4f85aa6a"###') == [('token = "ab8ca1b325bc4f85aa6a', "assign")]


def test_letters_only_values_are_judged_by_their_cost():
    found = lambda t: [t[a:b] for a, b, _ in secrets.spans_of(t)]
    assert found("pwd: hQzXvTbnWkRmLpYs") == ["hQzXvTbnWkRmLpYs"] and found("the passphrase is kvzqjwxmhtrbpl, so") == ["kvzqjwxmhtrbpl"]
    for word in "required optional mandatory authentication incorrect everywhere encrypted confidential changeme".split():
        assert found(f"password is {word}.") == [] and found(f"Login: {word.title()}") == [], word
    assert secrets.guess_cost("everywhere", ()) > 10 > secrets.guess_cost("everywhere")


def test_secrets_of_odd_rows(odd, none):
    rows = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["secrets"]] for r in secrets.scan(odd).where("doc_id = 9").collect()}
    assert [k for k, _, _ in rows[9]] == ["assign", "access", "hex"]
    assert secrets.scan(odd).count() == odd.count() and secrets.scan(none).count() == 0
    changed = secrets.redact(odd)
    assert changed.columns == odd.columns and changed.where("text is null").count() == 2
    assert changed.where("doc_id = 9").first()["text"].count("[secret]") == 3


# ---- top k ----


def test_ties_nulls_and_overflow(spark):
    rows = [(50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [0.5]), (6, [1e30, 1e30]), (None, [1.0, 1.0]), (7, []), (2, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in top_k.top_k(vectors, vectors.where("vec_id = 50")).orderBy("rank").collect()]
    assert got == [(1, 6, top_k.MOST), (2, 1, 65536), (3, 2, 65536), (4, 2, 65536), (5, 5, 32768)]
    assert top_k.top_k(vectors.where("false"), vectors).count() == 0 and top_k.top_k(vectors, vectors.where("false")).count() == 0


# ---- classifiers ----


def test_classifiers_learn_and_hold_out(spark, odd, none):
    r = random.Random(3)
    word = lambda: "".join(r.choice("aeiou") + r.choice("bcdfgklmnprst") for _ in range(3))
    docs, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        toxic, good = int(i % 4 == 0), int(i % 5 != 0)
        if toxic:
            for _ in range(4):
                words.insert(r.randrange(60), r.choice(["grimshaw", "vilewort", "nastikin"]))
        docs.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, good, toxic))
    documents, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module, label, at in ((toxicity, 2, "toxic"), (quality, 1, "quality")):
        model = module.train(documents, marks)
        got = {x["doc_id"]: x for x in module.score(documents, model).collect()}
        parts, held = module.FOLD
        out = [x for x in labels if zlib.crc32(str(x[0]).encode()) % parts == held]
        assert np.mean([got[x[0]]["predicted"] == x[label] for x in out]) > 0.95, at
        assert module.train(documents.repartition(5), marks.repartition(3)) == model
        strange = module.score(odd, model)
        assert strange.count() == odd.count() and strange.where("score between 0 and 1").count() == odd.count()
        assert module.score(none, model).count() == 0
        assert module.score(odd, module.train(documents, marks.where("false"))).where("score = 0").count() == odd.count()
    assert toxicity.keep_ordinary(odd, toxicity.train(documents, marks)).columns == odd.columns


def test_stretches_that_ordinary_texts_have_less_often():
    """Toxic texts of one language repeat a stem that a quarter of its ordinary texts have once; the other language has a word of its own."""
    r = random.Random(9)
    word = lambda s: "".join(r.choice(s) for _ in range(7))
    texts, labels = [], []
    for i in range(600):
        german, toxic = i % 3 == 0, i % 10 == 0
        words = [word("aeioubcdfg" if german else "klmnoprstu") for _ in range(60)]
        for _ in range(4 * toxic or german * (i % 4 == 0)):
            words.insert(r.randrange(60), "achlich" if german else "grimshaw")
        texts.append(" ".join(words))
        labels.append(int(toxic))
    model = toxicity.fit(texts[:400], labels[:400], [1.0] * 400)
    predicted = [int(s >= toxicity.PREDICT_FROM) for s in toxicity.scores(model, texts[400:])]
    for german in (True, False):
        assert [p for i, p in enumerate(predicted, 400) if (i % 3 == 0) == german and labels[i]].count(0) == 0
    assert sum(p for i, p in enumerate(predicted, 400) if not labels[i]) <= 4


def test_sum_of_squares_equals_all_pairs():
    r = np.random.default_rng(1)
    m = quality.Machine(np.zeros((quality.STATISTICS, quality.BINS - 1)), np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), 0.5, r.normal(size=50), r.normal(size=(50, 4)))
    place, x = np.array([3, 7, 20, 41]), np.array([0.5, 1.0, -2.0, 0.25])
    pairs = sum(m.v[place[i]] @ m.v[place[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert math.isclose(m.value(place, x), 0.5 + m.w[place] @ x + pairs)


# ---- language model ----


def test_scores_and_counts(spark, small, documents):
    tokens = {i: t.encode().lower().split() + [b""] for i, t in documents.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in documents}
    known = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, kinds = sum(known.values()), len(known)
    rows = {r["doc_id"]: r for r in QUERIES["op7_class_lm"](spark, small).collect()}
    for i, ws in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(known[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((known[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in ws), rel_tol=1e-9)


def test_classes_follow_neighbours(spark):
    r = random.Random(2)
    text = lambda a, b: " ".join(x for _ in range(30) for x in (r.choice(a), r.choice(b)))
    a, b = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    docs = spark.createDataFrame([(i, text(a, b)) for i in range(60)], "doc_id long, text string")
    rows = [r for r in class_lm.score(docs, classes=8).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1]
    gain = sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert len(rows) > 5 and gain > 0.2  # knowing the class is worth log10(2) for each word


def test_language_model_on_odd_rows(odd, none):
    rows = class_lm.score(odd).collect()
    assert len(rows) == odd.count() and all(r["n_tokens"] >= 1 and r["score"] < 0 for r in rows)
    assert class_lm.score(none).count() == 0
    assert class_lm.score(odd, fold=(1, 0)).where("n_known = 0 and train_tokens = 0").count() == odd.count()


# ---- repeated substrings ----


def _removed(rows):
    first, out = {}, []
    for i, t in sorted(rows):
        b = t.encode()
        covered = bytearray(len(b))
        strings = [b[j : j + 50] for j in range(len(b) - 49)]
        for j, s in enumerate(strings):
            if first.get(s, i) < i:
                covered[j : j + 50] = b"\1" * 50
        for s in strings:
            first.setdefault(s, i)
        spans = sum(1 for j in range(len(b)) if covered[j] and (j == 0 or not covered[j - 1]))
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((i, len(b), len(b) - len(kept), spans, sha(kept)))
    return sorted(out)


def test_repeats_by_brute_force(spark, small, documents):
    got = QUERIES["op8_repeated_substrings"](spark, small).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == _removed(documents.items())


def test_repeats_of_odd_rows(spark, odd, none):
    r = random.Random(4)
    words = ["".join(r.choice("abcdef") for _ in range(r.randint(1, 6))) for _ in range(30)]
    passage = " ".join(r.choice(words) for _ in range(40))
    rows = [(i, " ".join(r.choice(words) for _ in range(40)) + " " + passage[r.randrange(60) :][: r.randrange(200)]) for i in range(60)]
    rows += [(100, "x" * 500), (101, "x" * 300 + "y"), (102, "ab" * 100), (103, passage), (104, passage), (105, passage[:49]), (106, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = substrings.remove_repeats(docs, kept=False).collect()
    assert sorted(map(tuple, got)) == _removed(rows)
    found = substrings.remove_repeats(odd)
    assert found.count() == odd.count() and substrings.remove_repeats(none).count() == 0
    by_id = {r["doc_id"]: r for r in found.where("doc_id < 3").collect()}
    assert by_id[1]["n_removed"] == 0 and by_id[2]["n_removed"] == by_id[2]["n_bytes"]


def test_copies_in_any_order_within_a_task(spark):
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passage, own = text(120), text(150)
    rows = [(9, text(30) + own), (5, passage + own), (3, passage + own), (1, text(80) + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(map(tuple, substrings.remove_repeats(docs, kept=False).collect())) == _removed(rows)


def test_hot_anchors_are_split(spark, monkeypatch):
    """One passage of 30 bytes in all documents, among neighbours of which some are shared: no group has all of its pieces."""
    r = random.Random(8)
    text = lambda n: "".join(r.choice("abcdefghij é") for _ in range(n))
    middle, sides = text(30), [text(40) for _ in range(25)]
    rows = [(i, text(20) + r.choice(sides) + middle + r.choice(sides) + text(20)) for i in range(120)]
    rows += [(200 + i, text(60) + middle + text(60)) for i in range(80)] + [(300, middle + sides[0][:30]), (301, middle * 4), (302, "z" + middle * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups, dealt = spark.sparkContext.accumulator(0), substrings._found
    monkeypatch.setattr(substrings, "HOT", 10)

    def found(pieces, length):
        alone = F.when(F.col("at") == substrings.ALONE, F.col("piece")).otherwise(F.substring("piece", F.col("at") + 1, F.lit(substrings.GRAM)))
        groups.add(pieces.where("piece is not null").groupBy(alone).count().agg(F.max("count")).first()[0])
        return dealt(pieces, length)

    monkeypatch.setattr(substrings, "_found", found)
    assert sorted(map(tuple, substrings.remove_repeats(docs, kept=False).collect())) == _removed(rows)
    assert groups.value < 40


def test_suffix_arrays():
    r = random.Random(5)
    for k in range(300):
        t = np.array([r.randint(0, r.choice([1, 2, 5, 200])) for _ in range(r.randint(1, 70))])
        want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        assert suffixes.suffix_array(t).tolist() == want and suffixes._one_by_one(t.tolist(), int(t.max()) + 1) == want
    data = bytes(r.choice(b"ab") for _ in range(400))
    sa = suffixes.suffix_array(np.frombuffer(data, np.uint8))
    for least in (3, 9):
        shared = suffixes.common_prefixes(data, sa, least)
        for a, b in zip(sa[:-1], sa[1:]):
            assert shared[b] == (len(data) - max(a, b) >= least and data[a : a + least] == data[b : b + least])


def test_reduced_texts_are_sorted_with_arrays(monkeypatch):
    """Substrings that repeat are not sorted one by one."""
    r = random.Random(6)
    texts = [np.array([r.randint(0, k) for _ in range(n)]) for k, n in ((1, 300), (3, 500), (0, 50), (200, 400))] + [np.array([1, 2, 0, 3] * 60 + [1, 2, 0] * 40)]
    monkeypatch.setattr(suffixes, "_one_by_one", None)
    for t in texts:
        assert suffixes.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_anchors_of_many_texts_at_a_time(monkeypatch):
    """A block of texts is one pass; no string reaches from a text into the next."""
    r = random.Random(7)
    texts = ["".join(r.choice("ab c") for _ in range(r.choice([0, 20, 49, 50, 51, 90, 400]))).encode() for _ in range(60)] + [b"ab" * 40, b"x" * 70]

    alone = [(k, p, x) for k, t in enumerate(texts) for _, at, h in substrings.anchors([t]) for p, x in zip(at.tolist(), h.tolist())]
    gram = {}
    for k, p, x in alone:
        assert p + 24 <= len(texts[k]) >= 50 and gram.setdefault(x, texts[k][p : p + 24]) == texts[k][p : p + 24]
    for k, t in enumerate(texts):  # every string has one, and equal strings have theirs in the same places
        places = [p for n, p, _ in alone if n == k]
        assert all(any(j <= p <= j + 26 for p in places) for j in range(len(t) - 49))
    passes, one = [], substrings._anchors
    monkeypatch.setattr(substrings, "_anchors", lambda *a: passes.append(1) or one(*a))
    assert [(k, p, x) for n, at, h in substrings.anchors(texts) for k, p, x in zip(n.tolist(), at.tolist(), h.tolist())] == alone
    assert len(passes) == 1


# ---- similarity join ----


def _components(rows, percent=85):
    sets, label = {}, {i: i for i, _ in rows}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    edges = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return sorted((i, len(sets[i]), label[i]) for i in ids)


def test_links_of_near_copies(spark, monkeypatch):
    """Chains of ever more edits, where the smallest id is not linked with most of its group."""
    r = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for n in (1, 2, 3, 4, 5, 9, 10, 12, 40, 90, 250):
        base = [r.choice(words) for _ in range(n)]
        for _ in range(12):
            text = list(base)
            for _ in range(r.randint(0, max(1, n // 40))):
                text[r.randrange(n)] = r.choice(words)
            if r.random() < 0.5:
                base = text
            rows.append((i, " ".join(text).title() if i % 3 else " ".join(text)))
            i += 1
    r.shuffle(rows)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = jaccard.join(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == _components(rows)


def test_signatures_of_similar_sets_meet():
    r = np.random.default_rng(2)
    for _ in range(300):
        n = int(r.integers(1, 300))
        a = np.unique(r.integers(0, 1 << 60, n).astype(np.uint64))
        change = int(r.integers(0, 2 + n // 9))
        b = np.unique(np.concatenate([a[change:], r.integers(0, 1 << 60, int(r.integers(0, change + 1))).astype(np.uint64)]))
        if len(b) and jaccard.similar(a, b):
            assert np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)).size
        if len(b):
            assert jaccard.distances([jaccard.sketch(a)], [jaccard.sketch(b)])[0, 0] <= len(np.setxor1d(a, b))


def test_join_of_odd_rows(odd, none):
    rows = jaccard.join(odd).collect()
    assert len(rows) == odd.count() and all(r["component_id"] == 1 for r in rows if r["doc_id"] in (1, 2))
    assert {(r["doc_id"], r["component_id"]) for r in rows if r["n_shingles"] == 0} == {(3, 3), (4, 4), (5, 5), (None, None)}
    assert jaccard.join(none).count() == 0
    kept = jaccard.first_of_each(odd)
    assert kept.columns == odd.columns and kept.where("doc_id in (1, 2)").count() == 1 and kept.where("text is null").count() == 2
    assert jaccard.first_of_each(none).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 103: 100}


def test_empty_partitions_make_no_large_groups():
    """Random sets share hardly a signature; similar ones, differing as much as they may, still meet, at every size."""
    r = np.random.default_rng(11)
    draw = lambda n: np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
    _, shared = np.unique(np.concatenate([jaccard.signatures(draw(300)) for _ in range(3000)]), return_counts=True)
    assert shared.max() <= 10  # 26 without spare partitions
    for n in [*range(8, 420, 3)] * 6:
        a = draw(n)
        out = int(r.integers(0, 15 * len(a) // 115 + 1))
        b = np.unique(np.concatenate([r.permutation(a)[out:], draw(max(0, (15 * len(a) - 100 * out) // 85))]))
        if jaccard.similar(a, b):
            assert np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)).size


def test_only_signature_and_id_are_shuffled_for_the_centers(spark):
    sets = spark.createDataFrame([(i, [i % 7, i]) for i in range(50)], "id long, sigs array<long>")
    stars = jaccard._stars(sets)
    exchanges = [line for line in stars._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in line]
    assert len(exchanges) == 1 and stars._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["id"] for r in stars.collect()} | {r["center"] for r in stars.collect()} == set(range(50))


def test_decided_pairs_are_not_compared_again(spark):
    """A center and the classes of its star were compared: of a star of one class nothing is left, and of others not the center."""
    stars = [(1, 10, 20), (2, 10, 20), (2, 10, 30), (3, 10, 40), (3, 40, 50)]
    got = jaccard._members(spark.createDataFrame(stars, "sig long, center long, id long"))
    assert sorted(map(tuple, got.collect())) == [(2, 20), (2, 30), (3, 10), (3, 40), (3, 50)]


def test_all_with_a_near_one_elsewhere_stay_open():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([r.permutation(base)[int(r.integers(0, 30)) :], r.integers(0, 1 << 63, int(r.integers(0, 20)), dtype=np.uint64)])) for _ in range(60)]
    raw = [jaccard.sketch(s) for s in sets]
    for size in (12, 60):  # few are compared one by one
        at = list(range(size))
        args = (at, [i % 5 // 2 for i in at], [len(s) for s in sets[:size]], [int.from_bytes(x, "little") for x in raw[:size]], [8 * len(x) for x in raw[:size]], [None] * size, at, at, 85)
        all_pairs, none = jaccard.near_pairs(*args, True)
        pairs, others = jaccard.near_pairs(*args, False)
        assert not none and set(pairs) < set(all_pairs)
        assert {i for pair in pairs for i in pair} | set(others) == {i for pair in all_pairs for i in pair}


def test_only_texts_that_may_be_wanted_are_shuffled(spark):
    docs = spark.range(20000).selectExpr("if(id = 7, null, id) as doc_id", "'a' as text")
    wanted = docs.where("doc_id is null or doc_id % 1000 = 3").select("doc_id")
    kept = [r["doc_id"] for r in jaccard._perhaps(docs, wanted, "doc_id").collect()]
    assert {None, *range(3, 20000, 1000)} <= set(kept) and len(kept) < 100


def test_a_shuffled_signature_takes_few_bytes(spark):
    r = np.random.default_rng(5)
    rows = [(i, jaccard.packed(jaccard.signatures(np.unique(r.integers(0, 1 << 63, 300, dtype=np.uint64))))) for i in range(400)]
    stars = jaccard._stars(spark.createDataFrame(rows, "id long, sigs binary"))
    sent = stars._jdf.queryExecution().optimizedPlan().toString()
    assert "sigs#" in sent and "array<" not in stars.schema.simpleString()
    want = {}
    for i, raw in rows:
        for s in jaccard.unpacked(raw).tolist():
            want.setdefault(s, set()).add(i)
    got = {}
    for x in stars.collect():
        got.setdefault(x["sig"], set()).update((x["center"], x["id"]))
    assert got == {s: ids for s, ids in want.items() if len(ids) > 1} and all(len(raw) == 5 * len(jaccard.unpacked(raw)) for _, raw in rows)
