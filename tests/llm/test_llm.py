"""The training-data operators against brute force, on small tables with
nulls, empty and long texts, ties, repeated rows, clashing columns and
empty tables."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from segmentflow.llm import byte_bpe, chat, decontaminate, language_id, lsh_forest, near_dup, pii, token_store, toxicity, url_filter
from segmentflow.llm.common import held_out, text_slices

DOCS = "doc_id long, text string"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def texts_of(seed: int, n: int, alphabet: list[str], longest: int = 60) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


ODD = ["", None, " ", "a", "a  b\n\n c", " x ", "日本語 テスト", "é" * 40, "ab" * 2000, " " * 500, "\x1ca \x85b\xa0c", "<|endoftext|> x", "🙂🙂 12345 it'll"]


# ------------------------------------------------------------ byte BPE --
def test_byte_bpe_equals_the_library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    vocabulary = byte_bpe.Vocabulary(byte_bpe.vocabulary_tables(open(BYTE_BPE, "rb").read()))
    encoder = byte_bpe.Encoder(vocabulary, public_tokenizers.PATTERN)
    letters = texts_of(3, 30, list("etaoinshrdlu"), 400)
    cases = ODD + texts_of(1, 800, [*"ab cdÉé\n\t1.'s,!", "🙂", "  "]) + letters + ["".join(letters)[:3000]]
    for text, ids in zip(cases, encoder.encode(cases), strict=True):
        assert ids.tolist() == library.encode_ordinary(text or "")
        assert encoder.decode(ids.tolist()) == (text or "").encode()
    long = "".join(letters)[:2500].encode()
    assert vocabulary.merge_long(long).tolist() == np.frombuffer(vocabulary.merge_rows([long], 4096)[0], "<i4").tolist()


def test_byte_bpe_documents(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*ODD, "a", "a"])], DOCS + ", IDS string")
    rows = byte_bpe.encode_documents(df, BYTE_BPE, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) + 2 and all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    digests = {r.doc_id: r for r in byte_bpe.token_digests(df, BYTE_BPE, public_tokenizers.PATTERN, keep=["doc_id"]).collect()}
    for r in rows:
        assert digests[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    assert byte_bpe.encode_documents(df.limit(0), BYTE_BPE, public_tokenizers.PATTERN).count() == 0


# --------------------------------------------------------- token store --
def test_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    own = token_store.Tokenizer(open(WORD_BPE, "rb").read(), np.dtype("<u2"))
    cases = ODD + ["ΑΣ ΟΔΟΣ. ΣΑΣ's", "İstanbul", "ÀÉ. Öß ªº µ!!!! &&& b***", "x²¾ 3½×÷a ×É", "it's 'S ''s 'll'dd", "a\xa0b\x85c\x1cd\x0be", "e\u0301 É", "<|STARTOFTEXT|>a<|endoftext|>b", "".join(map(chr, range(1, 256))) * 2]
    cases += texts_of(12, 600, [chr(i) for i in range(1, 256)] + [*"'strevmld "] * 20) + texts_of(2, 600, [*"ab cdÉé\n\t1.'s,!Σ", "🙂", "é"])
    for text, raw in zip(cases, own(cases), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_token_store_round_trip(spark, tmp, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    rng = random.Random(4)
    texts = [*ODD, *["word " * rng.randint(0, 900) for _ in range(40)], "same", "same"]
    ids = [*range(len(texts) - 1), len(texts) - 2]
    order = list(zip(ids, texts, strict=True))
    rng.shuffle(order)
    manifest = token_store.write_sequences(spark.createDataFrame(order, DOCS).repartition(3), WORD_BPE, 2, folder=tmp + "/tokens", length=64)
    got = sorted(tuple(r) for r in token_store.read_documents(manifest).collect())
    start, want = 0, []
    for i, text in sorted(order, key=lambda x: x[0]):
        tokens = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
        start += len(tokens)
    assert got == sorted(want)
    file = manifest.orderBy("part", "roll").first()
    reader = token_store.SequenceFile(file.folder, file.path)
    assert reader.tokens(0).shape == (64,) and reader.mask(0).tolist() == [255] * 8
    for row in (reader.tokens(0), reader.mask(0)):  # views of the mapped file
        while isinstance(row.base, np.ndarray):
            row = row.base
        assert not row.flags.owndata
    empty = token_store.write_sequences(spark.createDataFrame([], DOCS), WORD_BPE, 2, folder=tmp + "/none")
    assert token_store.read_documents(empty).count() == 0


# ------------------------------------------------------------------ PII --
def brute_mentions(text):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    out = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_mentions_equal_plain_search():
    parts = ["a", "b.", "@", "1", "2", "+", ".", "-", " ", "(", ")", "1.2.3.4", "x@y.z", "+1 ", "4", "é", "4111111111111111"]
    for text in texts_of(5, 6000, parts, 40):
        assert pii.base_mentions(text) == brute_mentions(text)


PII_TEXTS = [
    "Call +1 (983) 555-7102 now. Later: 983-555-7102 again",
    "number 983-555-7102 alone",
    "mail jane.doe@x.org and Jane.Doe there",
    "ip 10.2.3.44, card 4111 1111 1111 1111",
    None,
    "",
]


def test_skip_chain_labels_repeats_only(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(PII_TEXTS)], DOCS + ", PII int")
    field = pii.train(df)
    rows = {r.doc_id: r for r in pii.find_pii(df, field).collect()}
    named = {i: [(m.kind, r.text[m.start : m.end], m.base) for m in r.pii] for i, r in rows.items()}
    assert named[0] == [("phone", "+1 (983) 555-7102", True), ("phone", "983-555-7102", False)]
    assert named[1] == [] and named[4] == [] and named[5] == []
    assert ("email", "Jane.Doe", False) in named[2]
    assert [k for k, _, _ in named[3]] == ["ip", "card"]
    clean = {r.doc_id: r.text for r in pii.redact(df, field).collect()}
    assert clean[0] == "Call [PHONE] now. Later: [PHONE] again" and clean[4] is None
    assert pii.find_pii(df.limit(0), pii.train(df.limit(0))).count() == 0


def test_repeats_beside_other_numbers():
    shapes = [(pii.shape(x), k, 100.0) for k, x in ((3, "+1 (983) 555-7102"), (3, "+1 555 123 4567"), (2, "4111 1111 1111 1111"))]
    field = pii.fit(shapes, np.zeros((pii.LABELS, pii.LABELS)), 0, 0)
    cases = {
        "Call +1 555 123 4567. dial 555 123 4567 10 times": ["555 123 4567"],
        "Call +1 555 123 4567 or +1 555 987 6543. ids 5551234567 5559876543": ["5551234567", "5559876543"],
        "Call +1 (983) 555-7102, then 983-555-7102 2nd try": ["983-555-7102"],
        "Call +1 (983) 555-7102. Or (983) 555-7102": ["(983) 555-7102"],
        "Call +1 (983) 555-7102. Or 001 983 555 7102": ["001 983 555 7102"],
        "Call +1 (983) 555-7102, then 7 983.555.7102 9, 983 555 7102 8 5551234567": ["983.555.7102", "983 555 7102"],
        "card 4111 1111 1111 1111, again 4111 1111 1111 1111 12/26": ["4111 1111 1111 1111"],
        "Call +1 555 123 4567. no 555 123 45678 nor x5551234567 10": [],
    }
    for text, want in cases.items():
        (found,) = pii.label_texts(field, [text])
        assert [text[m["start"] : m["end"]] for m in sorted(found, key=lambda m: m["start"]) if not m["base"]] == want


def test_marginals_equal_enumeration_on_a_tree():
    rng = np.random.default_rng(1)
    field = pii.Field(rng.normal(size=(pii.WIDTH, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), 2.0)
    doc = pii.Nodes([], [-1, 2, -1], [(0, 1)] * 3, [(7, 0, 0, 0, 1, 0, 0), (16, 0, 0, 0, 0, 0, 2), (8, 0, 0, 0, 0, 0, 0)], [(0, 1)], [(1, 2)])
    unary = field.unary[pii._rows(doc.shape)].sum(axis=1)
    p = np.zeros((3, pii.LABELS))
    for a in range(pii.LABELS):
        for c in range(pii.LABELS):
            w = np.exp(unary[0, a] + unary[2, c] + field.chain[a, 2] + field.skip * (c == 2))
            p[0, a] += w
            p[2, c] += w
    got = pii.marginals(field, [doc])
    assert np.allclose(got[[0, 2]], p[[0, 2]] / p[[0, 2]].sum(axis=1, keepdims=True), atol=1e-2)


# ------------------------------------------------ toxicity and language --
def toy_corpus(seed, n):
    rng = random.Random(seed)
    words = {"en": "the and this that with from house".split(), "fr": "le la dans pour avec maison être".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        w = [rng.choice(words[lang]) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "moron"]) if lang == "en" else "crétin")
        rows.append((i, " ".join(w), lang, toxic))
    return rows


SCHEMA = "doc_id long, text string, lang string, toxic int"


def test_toxicity_held_out(spark):
    df = spark.createDataFrame(toy_corpus(1, 600), SCHEMA)
    model = toxicity.train(df, ~held_out())
    extra = spark.createDataFrame([(-1, None, "en", 0), (-2, "", "en", 0), (-3, "", "en", 0)], SCHEMA)
    rows = toxicity.score_documents(df.union(extra).withColumn("Score", F.lit("x")), model).withColumn("h", held_out()).collect()
    test = [r for r in rows if r.h and r.doc_id >= 0]
    assert sum(r.predicted == r.toxic for r in test) >= 0.97 * len(test)
    empty = {r.score for r in rows if r.doc_id < 0}
    assert len(empty) == 1 and 0 <= empty.pop() <= 1
    assert toxicity.score_documents(df.limit(0), toxicity.train(df.limit(0), ~held_out())).count() == 0


def test_language_held_out(spark):
    df = spark.createDataFrame(toy_corpus(2, 400), SCHEMA)
    model = language_id.train(df, ~held_out())
    extra = spark.createDataFrame([(-1, None, None, 0), (-2, "12 34", None, 0), (-3, "\u4f60\u597d", None, 0)], SCHEMA)
    rows = language_id.identify(df.union(extra), model).withColumn("h", held_out()).collect()
    test = [r for r in rows if r.h and r.doc_id >= 0]
    assert sum(r.lang_pred == r.lang for r in test) >= 0.98 * len(test) and not any(r.lang_rejected for r in test)
    odd = {r.doc_id: r for r in rows if r.doc_id < 0}
    assert odd[-1].lang_pred == odd[-2].lang_pred == "und" and odd[-1].score == 0
    assert odd[-3].lang_rejected
    none = language_id.train(df.limit(0), ~held_out())
    assert {r.lang_pred for r in language_id.identify(df, none).collect()} == {"und"}


def test_language_rejection_is_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang").where("text is not null")
    model = language_id.train(docs, ~held_out() & (F.col("lang") != "de"))
    rng = random.Random(6)
    noise = [(-1 - i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz" + "     ") for _ in range(600)), "noise") for i in range(100)]
    rows = language_id.identify(docs.where(held_out()).union(spark.createDataFrame(noise, docs.schema)), model).collect()
    share = lambda rows: sum(r.lang_rejected for r in rows) / len(rows)
    assert share([r for r in rows if r.lang not in ("de", "noise")]) <= 0.01
    assert share([r for r in rows if r.lang == "de" and len(r.text.split()) >= 100]) >= 0.9
    assert share([r for r in rows if r.lang == "noise"]) >= 0.95


def test_word_sums_equal_averaged_embeddings():
    model = language_id.fit([("a", *language_id._counts(["xx", "yy"], 16), b"", b""), ("b", *language_id._counts(["zz"], 16), b"", b"")])
    scorer = language_id.Scorer({"logits": model.logits, "languages": model.languages})
    label, score = scorer(["xx zz xx"])
    buckets, _ = language_id.hashed_ngrams(["xx", "zz", "xx"], language_id.SIZES, 16)
    want = language_id._softmax(model.logits[buckets].astype(float).mean(axis=0)[None])[0]
    assert abs(score[0] - want.max()) < 1e-9


# ------------------------------------------------------ near duplicates --
def brute_components(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        sets.setdefault(i, []).append(frozenset(grams))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_corpus():
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.choice([1, 2, 8, 25])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += [None, "", "  ", "one two", "One TWO", "one two three", "x " * 3000, "x " * 2000]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_corpus()
    got = near_dup.near_duplicates(spark.createDataFrame([(*r, 0, "x") for r in rows], DOCS + ", kept int, band string").repartition(4)).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (want[r.doc_id] == r.doc_id) for r in got)


def test_near_duplicates_repeated_and_null_ids(spark):
    long = " ".join(f"a{k}" for k in range(30))
    other = " ".join(f"b{k}" for k in range(30))
    rows = [(1, long), (5, long), (5, other), (5, other), (7, other), (9, "alone here"), (9, "alone here")]
    df = spark.createDataFrame([*rows, (None, long)], DOCS)
    got = near_dup.near_duplicates(df).collect()
    want = brute_components(rows)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == sorted((i, want[i]) for i, _ in rows)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_odd_sketch_estimates():
    rng = np.random.default_rng(2)
    a, b = near_dup._hashes()
    for share in (0.75, 0.9):
        common = int(2 * 1000 * share / (1 + share))
        errors = []
        for _ in range(20):
            x = rng.integers(0, 1 << 63, 2000 - common, np.uint64)
            s = np.array([near_dup.signature(v, a, b) for v in (x[:1000], x[1000 - common :])])
            k = near_dup.odd_sketch(s).view(np.uint64)
            bits = int(np.bitwise_count(k[0] ^ k[1]).sum())
            assert bits <= near_dup.MOST_BITS
            n = near_dup.SKETCH_BITS
            errors.append(1 + n / (4 * near_dup.HASHES) * np.log(1 - 2 * bits / n) - share)
        assert abs(np.mean(errors)) < 0.04


# ------------------------------------------------------------------ URLs --
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def test_url_model_on_held_out_labels():
    """Five folds of the labelled table, each judged by a model that did not
    see it."""
    rows = sorted(url_filter.LABELLED, key=lambda r: zlib.crc32(r[0].encode()))
    right = 0
    for fold in range(5):
        weights, bias = url_filter.train([r for i, r in enumerate(rows) if i % 5 != fold])
        for url, label in rows[fold::5]:
            z = bias
            for part, (text, share) in enumerate(zip(url_filter.split_url(url), (1.0, url_filter.PATH_SHARE), strict=True)):
                f = url_filter.features([text], part)[0]
                z += share * weights[f].sum() * max(len(f), 1) ** -0.5
            right += (z >= 0) == label
    assert right / len(rows) >= 0.8


def test_url_rules_and_model(spark):
    urls = [None, "", "no-scheme.com/en/", "http://WWW.Example.com/en/x?q=1", "https://a.example.com/en/1", "https://example.com", "ftp://x.NET/es/9#t",
            "http://notexample.com/en/", "http://h\n/p\nq?r", "x://a://b/c", "http://free-casino.example.org/win", "http://garden.example.org/roses", "https://É.com/A"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls * 2)], "page_id long, url string, HOST string")
    model = url_filter.train()
    rows = url_filter.judge(df, RULES, model).collect()
    assert len(rows) == 2 * len(urls)
    for r in rows:
        host, path, rule, action = brute_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (action or ("block" if r.score >= 0.5 else "allow"))
    by = {r.url: r.verdict for r in rows}
    assert by["http://free-casino.example.org/win"] == "block" and by["http://garden.example.org/roses"] == "allow"
    assert url_filter.judge(df.limit(0), RULES, model).count() == 0


# ------------------------------------------------------------------ chat --
def test_rotation(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"), (1, None, None, "?"), (2, 0, "system", "x"), (None, 300, "cat", "m")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, speaker int")
    got = {(r.conv_id, r.speaker, r.segment): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, s, 0) for s in ("ann", "bob", "unknown")} | {(None, "cat", 0)}
    ann = got[1, "ann", 0]
    assert ann.text == "<|user:unknown|>\n?<|end|>\n<|system|>\nbe<|end|>\n<|assistant|>\nhi <\\|end|><|end|>\n<|user:bob|>\n<|end|>\n<|assistant|>\nbye<|end|>\n"
    assert [ann.text[s.start : s.end] for s in ann.mask] == ["hi <\\|end|><|end|>", "bye<|end|>"]
    assert chat.rotate(df.limit(0)).count() == 0


def test_rotation_equals_sql(spark):
    import duckdb

    from segmentflow.llm.queries import oracle_sql, queries

    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    got = sorted(tuple(r) for r in queries()["op7_perspectives"](spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(con.execute(oracle_sql()["op7_perspectives"]).fetchall())


def test_rotation_splits_long_conversations(spark):
    rows = [(1, -2, "system", "rules"), (1, -1, "system", "more"), (1, 300, "system", "late")]
    rows += [(1, t * 1000, f"s{t % 2}", f"m{t}") for t in range(700)]  # sparse turns
    rows += [(2, 0, "a", f"x{k:04}") for k in range(600)]  # a crowded turn
    rows += [(3, t * 1000, "ab"[t % 2], f"y{t}") for t in range(4)] + [(4, k, "system", f"z{k}") for k in range(600)] + [(4, 600, "a", "end")]
    out = {(r.conv_id, r.speaker, r.segment): r for r in chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k[2] for k in out if k[0] == 1} == {0, 1, 2} and max(r.n_messages for r in out.values()) <= chat.SEGMENT + chat.OPENING
    opening = "<|system|>\nrules<|end|>\n<|system|>\nmore<|end|>\n"
    assert all(out[1, "s0", g].text.startswith(opening) for g in (0, 1, 2)) and sum("late" in out[1, "s0", g].text for g in (0, 1, 2)) == 1
    said = re.findall(r"m(\d+)<", "".join(out[1, "s0", g].text for g in (0, 1, 2)))
    assert said == [str(t) for t in range(700)]
    assert re.findall(r"x(\d+)<", "".join(out[2, "a", g].text for g in range(3))) == [f"{k:04}" for k in range(600)]
    assert out[3, "a", 0].n_messages == 4 and len(out[3, "a", 0].mask) == 2
    assert sum(r.n_messages for k, r in out.items() if k[0] == 4) == 601 + 2 * chat.OPENING


def test_rotation_of_spread_conversations_equals_sql(spark):
    """A conversation over many range partitions, with few messages a
    segment."""
    import duckdb

    from segmentflow.llm.queries import oracle_sql

    rng = random.Random(11)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(-3, 900)]), rng.choice([None, "system", "ann", "bob"]), rng.choice([None, "", "<|x", f"t{k}"])) for k in range(2500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key, old = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, "7")
    try:
        views = chat.rotate(df).collect()
    finally:
        spark.conf.set(key, old)
    got = [(r.conv_id, r.speaker, r.segment, r.text, ",".join(f"{s.start}:{s.end}" for s in r["mask"]), r.n_messages) for r in views]
    con = duckdb.connect()
    con.register("frame", df.toArrow())
    con.execute("CREATE TABLE conversations AS SELECT * FROM frame")
    want = con.execute(oracle_sql()["op7_perspectives"]).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 20


# --------------------------------------------------------------- vectors --
def test_forest_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 16))
    x[100:160] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] * 16), (9005, []), (None, x[1].tolist()), (9020, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in lsh_forest.nearest(df, F.col("vec_id") % 20 == 0, block=200, group=13).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    assert 9020 not in got
    hits = total = 0
    for q in range(0, 600, 20):
        score = x @ x[q]
        want = [i for i in np.lexsort((np.arange(600), -score.round(9))) if i != q][:20]
        hits += len({i for i, _ in got[q]} & set(want))
        total += 20
        assert all(abs(s - score[i]) < 1e-9 for i, s in got[q])
    assert hits >= 0.9 * total
    assert [i for i, _ in got[0]] == [*range(100, 120)]
    few = df.where("vec_id in (0, 1, 2)")
    assert lsh_forest.nearest(few, F.col("vec_id") == 0).count() == 2
    assert lsh_forest.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# -------------------------------------------------------- contamination --
ITEM = "If Anna has 12 kg of apples and sells 5 kg of apples to Bob Miller then how many apples does Anna keep after the sale is done"


def test_templates_catch_changed_slots(spark):
    changed = ITEM.replace("Anna", "Carla").replace("12 kg", "30 lb").replace("5 kg", "7 lb").replace("Bob Miller", "John")
    mixed = changed.replace("does Carla", "does Peter")
    rows = [(1, "Intro words here. " + ITEM + ", ok"), (2, changed), (3, mixed), (4, "unrelated text with 12 kg of apples and sells"), (5, None), (6, ""), (7, ITEM), (7, ITEM), (None, ITEM), (8, " ".join(ITEM.split()[:10])), (9, "short item")]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", item_id int")
    bench = spark.createDataFrame([(1, ITEM), (2, "short item"), (3, None), (None, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (round(r.coverage, 2), r.exact, r.start) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(1, 1): (1.0, True, 3), (2, 1): (1.0, False, 0), (7, 1): (1.0, True, 0), (9, 2): (1.0, True, 0)}
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def found(spark, docs, items, **options):
    df = spark.createDataFrame(list(enumerate(docs)), DOCS)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(df, bench, **options).collect()}


def test_verbatim_copies_of_items_without_windows(spark):
    items = [
        "What is the capital of France?",  # fewer tokens than a window
        "Is 91 prime?",  # a number among few words
        "12 + 30 = 42 , 15 + 28 = 43 , 11 + 9 = 20",  # placeholders alone
        "then Anna Miller met Bob Stone with Carl Wood and Dora Hill near Erie Lake",  # few tokens, many names
        "name one of the rivers of northern Spain",  # one window, lost when its first word is a name
        "we saw Ann in the park today and they all came here with Ann",  # ends in a name
        "Paris",
        "?!",
    ]
    around = "some words before it %s However there are more words after it in this text"
    docs = [around % x for x in items] + [*items, None, ""]
    docs[4] = docs[4].replace("name one", "Name one")
    got = found(spark, docs, items)
    assert set(got) == {(i, i) for i in range(7)} | {(i + 8, i) for i in range(7)}
    assert all(r.coverage == 1.0 and r.exact for r in got.values())
    assert {got[i, i].start for i in (0, 1, 2, 5)} == {4}
    changed = [around % "Is 97 prime?", around % "What is the capital of Spain?", around % "12 + 31 = 43 , 15 + 29 = 44 , 11 + 8 = 19"]
    assert found(spark, changed, items) == {}
    strict = found(spark, ["we met Name one of the rivers of northern Spain that are long"], ["name one of the rivers of northern Spain that are long"], coverage=1.0)
    assert set(strict) == {(0, 0)}


def test_slots_are_tested_on_every_alignment(spark):
    changed = ITEM.replace("Anna", "Carla").replace("does Carla", "does Peter")
    cups = ", ".join(f"add {k} cups" for k in range(2, 22))
    repeated = "take the big pan and " + cups + " of fine white flour to it"
    half = " ".join(repeated.split()[:48])
    got = found(spark, [changed + ". " + ITEM + ".", changed, repeated, "so " + half, changed + ". " + changed], [ITEM, repeated])
    assert set(got) == {(0, 0), (2, 1), (3, 1)}
    assert got[0, 0].start == len(decontaminate.Templates()([(changed + ".").encode()])[0]) and got[0, 0].exact and got[0, 0].coverage == 1.0
    assert got[2, 1].start == 0 and got[2, 1].exact and got[2, 1].coverage == 1.0
    assert got[3, 1].start == 1 and got[3, 1].exact and got[3, 1].coverage >= 0.5


def test_windows_equal_plain_windows():
    text = " ".join(texts_of(8, 60, list("abc"), 4)).encode()
    value, literal, _, doc, _ = decontaminate.Templates()([text, None, b"one two", text])
    _, at = decontaminate.windows(value, literal, doc)
    for d in (0, 3):
        n = int((doc == d).sum())
        assert int((doc[at] == d).sum()) == n - decontaminate.WINDOW + 1
    assert int((doc[at] == 2).sum()) == 1


# ---------------------------------------------------------------- shared --
def test_text_slices_keep_every_row():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in [0, 5, 100, 3, 3, 0, 50]])], names=["t"])
    parts = [p.column(0).to_pylist() for p in text_slices(batch, "t", 10)]
    assert [x for p in parts for x in p] == batch.column(0).to_pylist() and len(parts) >= 4


@pytest.mark.parametrize("name", ["op1_pii", "op6_url_filter", "op7_perspectives"])
def test_queries_run(spark, name):
    from segmentflow.llm.queries import queries

    assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0
