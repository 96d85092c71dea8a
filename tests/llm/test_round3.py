"""Product quantisation, FM-index search schemes and the box tree against
brute force, with nulls, ties, repeated rows, odd lengths, clashing columns
and empty tables."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmentflow.llm import box_tree, pq_links, spelling

SF = "/root/testdata/sf0.001"


def unit(rng, n, dim):
    x = rng.normal(size=(n, dim))
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


# ---------------------------------------------------- product quantisation --
def components_of(n, links):
    label = list(range(n))
    for _ in range(n):
        new = [min([label[i], *(label[j] for j in links[i])]) for i in range(n)]
        if new == label:
            return label
        label = new


@pytest.mark.parametrize(("dim", "noise"), [(24, 0.05), (3, 0.3), (1, 0.1)])
def test_links_equal_all_pairs(spark, dim, noise):
    rng = np.random.default_rng(dim)
    x = unit(rng, 300, dim)
    x[50:170] = x[0] + noise / np.sqrt(dim) * rng.normal(size=(120, dim))  # a dense group
    x[170:190] = x[1]  # exact copies
    x[190:200] = 3.5 * x[2]  # of another length
    x[200] = 0.97 * x[0] + 0.26 * x[3]
    u = x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    links = [np.flatnonzero(r).tolist() for r in near]
    label = components_of(300, links)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, KEPT int")
    got = {r.vec_id: r for r in pq_links.near_vectors(df, block=40, list_rows=20).collect()}
    assert len(got) == 300
    for i in range(300):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), label[i], label[i] == i)


def test_links_of_odd_vectors(spark):
    v = [0.6, 0.8]
    rows = [(5, v), (3, v), (3, v), (1, None), (2, [0.0, 0.0]), (4, [float("nan"), 1.0]), (6, [None, 1.0]), (7, []), (8, [0.6, 0.8, 0.0]),
            (9, [float("inf"), 1.0]), (None, v), (None, None), (10, [6e200, 8e200]), (11, [6e-200, 8e-200]), (12, [0.8, -0.6]), (12, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: tuple(r)[1:] for r in pq_links.near_vectors(df).collect()}
    group = dict.fromkeys((3, 5, 10, 11), 3)
    assert got == {i: (3, 3, i == 3) for i in group} | {i: (0, i, True) for i in (1, 2, 4, 6, 7, 8, 9, 12)} | {None: (0, None, True)}
    assert pq_links.near_vectors(df.limit(0)).count() == 0
    assert pq_links.near_vectors(df.where("vec_id = 1")).count() == 1


def test_code_bounds_hold():
    rng = np.random.default_rng(4)
    x = unit(rng, 800, 32)
    index = pq_links.Index(pq_links.fit_index(x[:400], 6, 0.9))
    of, code, err, asked = index.encode(x)
    assert asked[np.arange(800), of].all()
    for c in range(6):
        rows = np.flatnonzero(of == c)
        d = np.sqrt(np.concatenate([d2.T for _, d2 in index.distances(x[:150], c, code[rows].astype(np.int64))]))
        true = np.sqrt(pq_links.squares(x[:150], x[rows]))
        assert (d - err[rows] <= true + 1e-5).all() and (true <= d + err[rows] + 1e-5).all()


# ----------------------------------------------------------------- spelling --
def edits(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute_words(rows, typo):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if typo and h % typo == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [x for x in n if edits(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def spelled(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, Word string")
    return {r.word: tuple(r)[1:] for r in spelling.spelling_variants(df, **options).collect()}


@pytest.mark.parametrize(("typo", "cell_chars", "hot"), [(None, 1 << 16, 4096), (3, 300, 2), (5, 60, 1)])
def test_spelling_equals_brute_force(spark, typo, cell_chars, hot):
    rng = random.Random(hot)
    words = ["".join(rng.choice("abÉ×") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    words += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "Straßenbahn", "strassenbahn", "INTERNATIONAL", "internatonal", "internationnal", "internaxional"]
    weight = [rng.choice([1, 3, 40]) for _ in words]
    rows = [(rng.choice([None, *range(20)]), " ".join(rng.choices(words, weight, k=rng.randint(0, 60)))) for _ in range(60)]
    rows += [(3, ""), (4, None), (5, "12 ,-"), (6, "onlyhere oncehere"), *rows[:3]]
    assert spelled(spark, rows, typo=typo, cell_chars=cell_chars, hot=hot) == brute_words(rows, typo)


def test_spelling_of_long_texts_and_words(spark):
    long = "ab" * 3000
    text = " ".join([long, long, long[:-1], long[:-1], "x" + long] + ["x" + long] * 40)
    rows = [(1, text), (2, "vertical " * 30_000 + "verticl verticl")]
    got = spelled(spark, rows)
    assert got == brute_words(rows, None) and got[long][0] == "x" + long and got["verticl"][1] == "vertical"
    assert spelled(spark, rows[:0] or [(1, None)]) == {}
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_intervals_of_both_sides_stay_in_step():
    words = sorted({"banana", "bandana", "ananas", "nab", "naab"})
    index = spelling.WordIndex(words)
    text = "$" + "$".join(words) + "$"
    code = {chr(p): i + spelling.MARK + 1 for i, p in enumerate(index.letters)} | {"$": spelling.MARK}
    for pattern in ("an", "ana", "$na", "a$b", "band", "zz"[:0] + "naab$"):
        at = other = np.zeros(1, np.int64)
        size = np.array([len(text) + 1])
        mid = len(pattern) // 2
        for c in reversed(pattern[:mid]):
            at, other, size = index.forward.extend(at, other, size, np.array([code[c]]))
        for c in pattern[mid:]:
            other, at, size = index.backward.extend(other, at, size, np.array([code[c]]))
        found = sorted(index.forward.suffixes[at[0] : at[0] + size[0]].tolist())
        assert found == [m.start() for m in re.finditer(f"(?={re.escape(pattern)})", text)]


# ----------------------------------------------------------------- box tree --
def brute_negatives(rows, is_anchor, positives=5, negatives=3):
    out = set()
    for a, la, va in rows:
        if not is_anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(va, v, strict=True)) for i, _, v in rows if i != a}
        label = {i: l for i, l, _ in rows}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if label[i] == la][:positives]:
            fits = [i for i in order if label[i] != la and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out |= {(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fits[:negatives])}
    return out


@pytest.mark.parametrize(("dim", "labels", "scale"), [(8, 3, 256), (2, 40, 4), (1, 2, 2)])
def test_negatives_equal_brute_force(spark, dim, labels, scale):
    rng = np.random.default_rng(dim)
    x = np.round(rng.normal(size=(260, dim)) + 0.4, 3)
    x[100:180] = x[0]  # one vector, ties by id
    label = rng.integers(0, labels, 260)
    label[150:230] = 0  # a crowded label
    df = spark.createDataFrame([(i, int(k), v.tolist(), 1) for i, (k, v) in enumerate(zip(label, x, strict=True))], "vec_id long, label int, embedding array<double>, RANK int")
    got = box_tree.hard_negatives(df, F.col("vec_id") % 7 == 0, scale=scale, tile=25)
    rows = [(i, int(label[i]), [int(c) for c in np.floor(x[i] * scale)]) for i in range(260)]
    assert {tuple(r) for r in got.collect()} == brute_negatives(rows, lambda i: i % 7 == 0)


def test_negatives_of_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.0]), (2, 2, [0.75, 0.0]), (3, 2, None), (4, None, [0.75, 0.0]), (5, 2, [None, 1.0]),
            (6, 2, [float("nan"), 1.0]), (None, 2, [0.75, 0.0]), (7, 2, []), (8, 2, [0.75]), (9, 2, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    got = [tuple(r) for r in box_tree.hard_negatives(df, F.col("vec_id") == 0, scale=4).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2, 16, 12), (0, 1, 2, 8, 16, 12)]
    assert box_tree.hard_negatives(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert box_tree.hard_negatives(df, F.lit(False)).count() == 0
    assert box_tree.hard_negatives(df, F.col("vec_id") % 2 == 0, F.lit(None)).count() == 0
    # Products beyond what doubles hold exactly.
    far = [(0, 1, [65535.0]), (1, 1, [65535.0]), (2, 2, [60000.25]), (3, 2, [60000.0])]
    got = box_tree.hard_negatives(spark.createDataFrame(far, "vec_id long, label long, embedding array<double>"), F.col("vec_id") == 0)
    q, n = 65535 * 256, [60000 * 256 + 64, 60000 * 256]
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 2, q * q, q * n[0]), (0, 1, 2, 3, q * q, q * n[1])]
    with pytest.raises(Exception, match="out of range"):
        box_tree.hard_negatives(spark.createDataFrame([(0, 1, [1e6])], "vec_id long, label long, embedding array<double>"), F.lit(True)).collect()


def test_box_bounds_and_pruning():
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.normal(size=(900, 6)))
    tree = box_tree.BoxTree(np.arange(900), rng.integers(0, 3, 900), v)
    for cuts, low, high, l_low, l_high, least in tree.levels[:1]:
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            down, up = box_tree.score_bounds(v[:4], low[i : i + 1], high[i : i + 1])
            score = v[:4] @ tree.v[a:b].T
            assert (down <= score.min(axis=1, keepdims=True)).all() and (up >= score.max(axis=1, keepdims=True)).all()
            assert l_low[i] == tree.labels[a:b].min() and l_high[i] == tree.labels[a:b].max() and least[i] == tree.ids[a:b].min()


@pytest.mark.parametrize("name", ["op11_pq_links", "op12_spelling", "op13_hard_negatives"])
def test_queries_equal_sql(spark, name):
    import duckdb

    from segmentflow.llm.queries import oracle_sql, queries

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries()[name](spark, SF).select(*columns).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want.fetchall(), key=key)


# ----------------------------------------------------------- the samples --
def test_sample_counts_keys_not_rows(spark):
    from segmentflow.llm.language_id import bounded_sample

    rows = [(i % 3, "en", f"hello {i % 3}") for i in range(20_000)] + [(100 + i, "de", f"hallo {i}") for i in range(500)]
    rows += [(None, "fr", f"bon {i}") for i in range(30)] + [(700, "xx", "a" * 500), (701, "xx", "b")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = bounded_sample(df, "doc_id", "lang", 50, "text", 480).collect()
    n = {g: sum(r.lang == g for r in got) for g in ("en", "de", "fr", "xx")}
    assert n["en"] == 3 and n["fr"] == 30 and n["xx"] == 1 and 45 <= n["de"] <= 50 and len(set(got)) == len(got)
    assert sum(len(r.text) for r in got if r.lang == "de") <= 480
    assert bounded_sample(df.limit(0), "doc_id", "lang", 50).count() == 0


def test_held_out_is_never_null(spark):
    from segmentflow.llm.common import held_out

    df = spark.createDataFrame([(1,), (None,), (5,)], "doc_id long")
    assert [r[0] for r in df.select(held_out()).collect()] == [zlib.crc32(b"1") % 5 == 0, True, zlib.crc32(b"5") % 5 == 0]


def test_toxicity_scores_equal_plain_sums(spark):
    from segmentflow.llm import toxicity

    rng = np.random.default_rng(6)
    weights, bias = rng.normal(size=1 << toxicity.BITS).astype(np.float32), 0.25
    texts = ["You vile FOOL", "vile vile fool go", "kind words, good day", "", None, "x" * 50_000 + " y", "día añ"]
    df = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, SCORE string")
    got = {r.doc_id: r for r in toxicity.score_documents(df, (weights, bias)).collect()}
    for i, text in enumerate(texts):
        # A text's features are those of its words.
        found = set().union(*(toxicity.Features()([w])[0].tolist() for w in (text or "").lower().split()))
        score = 1 / (1 + np.exp(-(sum(float(weights[f]) for f in found) / np.sqrt(len(found) or 1) + bias)))
        assert abs(got[i].score - score) < 1e-4 and got[i].predicted == int(score >= 0.5)


# --------------------------------------------------------- contamination --
def brute_contaminated(docs, items, coverage=0.5):
    """Every alignment of every pair, in plain Python over the windows."""
    from segmentflow.llm import decontaminate as d

    def sides(texts):
        out = []
        for text in texts:
            (value, literal, spans, doc, words), (raw, owner, token) = d.Templates().with_raw([text.encode()])
            h, at = d.windows(value, literal, doc)
            slots = [d._slots(literal, spans, words, a, len(doc)) for a in at.tolist()]
            out.append(([(int(a), int(x), s, int(a)) for a, x, s in zip(at, h, slots, strict=True)], raw, owner, token))
        return out

    def raws(side, k):
        _, raw, owner, token = side
        h, at = d.raw_windows(raw, owner, k)
        return [(int(a), int(x), "", int(token[a])) for a, x in zip(at, h, strict=True)]

    best = {}
    all_docs, all_items = sides(docs), sides(items)
    for i, doc in enumerate(all_docs):
        for j, item in enumerate(all_items):
            k = min(len(item[1]), d.WINDOW)
            for raw, a, b in ((False, doc[0], item[0]), (True, raws(doc, k) if k else [], raws(item, k) if k else [])):
                need = (1.0 if raw and item[0] else coverage) * len(b)
                if raw and k < d.WINDOW:
                    a = [next(x for x in a if x[1] == h) for h in {x[1] for x in a}]
                hits = [(x[0] - y[0], y, x) for x in a for y in b if x[1] == y[1]]
                drift = 0 if raw else d.DRIFT
                for about in {s + e for s, _, _ in hits for e in range(-drift, drift + 1)}:
                    for strict in (False, True):
                        of = {}
                        for shift, y, x in hits:
                            gap = abs(shift - about)
                            if gap <= (0 if strict else drift):
                                key = (gap, shift, x[3] - y[3], x[2], y[2])
                                of[y[0]] = min(of.get(y[0], key), key)
                        if not of or len(of) < need:
                            continue
                        slots = [(m[4], m[3]) for m in of.values() if m[3] != ""]
                        pairs = {p for s, t in slots for p in zip(s.split("\x1f"), t.split("\x1f"), strict=True)}
                        if len(pairs) != len({p[0] for p in pairs}):
                            continue
                        begin = of[min(of)][2] if raw else about
                        got = (len(of) / len(b), sum(m[0] == 0 for m in of.values()) / len(b), -begin, all(s == t for s, t in slots), not raw, len(of))
                        best[i, j] = max(best.get((i, j), got), got)
    return {p: (m[5], min(m[0], 1.0), m[3], -m[2]) for p, m in best.items()}


def contaminated(spark, docs, items):
    from segmentflow.llm import decontaminate

    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, COVERAGE int")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.n_windows, r.coverage, r.exact, r.start) for r in decontaminate.contaminated(df, benchmark).collect()}


def test_contamination_equals_brute_force(spark):
    rng = random.Random(9)
    words = [*"alpha beta gamma delta pan egg salt dish cook cups Anna Bob Rome 3 4 17 kg".split(), "add"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    preamble = "please read the following question with care and give one short answer to it now"
    items = [f"{preamble} {text(n)}" for n in (4, 12, 30)] + [text(n) for n in (3, 7, 9, 20, 40)] + ["add 2 cups " * 6, "3 4 17 3 4"]

    def changed(t):
        return " ".join(str(int(w) + 1) if w.isdigit() else w if rng.random() > 0.04 else "zzz" for w in t.split())

    docs = [f"{text(5)} {rng.choice([changed, str])(rng.choice(items))} {text(rng.choice([0, 6]))}" for _ in range(60)]
    docs += [preamble, f"{preamble} {text(50)}", *items, "", items[5][:60], f"{items[6]} {items[6]}"]
    got, want = contaminated(spark, docs, items), brute_contaminated(docs, items)
    assert got == want and len(want) > 50


def test_shared_preambles_stage_no_pairs(spark, monkeypatch):
    from segmentflow.llm import decontaminate

    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    preamble = " ".join(word() for _ in range(20))
    items = [f"{preamble} {' '.join(word() for _ in range(40))}" for _ in range(80)]
    docs = [f"{preamble} {' '.join(word() for _ in range(30))}" for _ in range(200)] + [items[3]]
    rows = {}
    saved = decontaminate.staged

    def counted(df, name):
        out = saved(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "staged", counted)
    assert {p for p in contaminated(spark, docs, items)} == {(200, 3)}
    assert rows["matches"] < 500 and rows["found-windows"] < 30 * len(docs) + 200


def test_contamination_of_a_very_long_text(spark):
    item = "how many litres of paint does one need to cover a wall of forty square metres twice"
    docs = ["word " * 300_000 + item + " end" * 100_000, None, "nothing here"]
    got = contaminated(spark, docs, [item, "x"])
    assert set(got) == {(0, 0)} and got[0, 0][1] == 1.0 and got[0, 0][3] == 300_000


# ---------------------------------------------------------------- forest --
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_forest_recall_of_the_query(spark, sf):
    """Production parameters on the given table, 5 % of its rows as queries,
    against all products."""
    from segmentflow.llm.queries import queries

    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    v = np.array([r.embedding for r in rows], np.float64)
    ids = np.array([r.vec_id for r in rows])
    got = collections.defaultdict(list)
    for r in queries()["op9_lsh_forest"](spark, folder).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits, asked = 0, np.flatnonzero(ids % 20 == 0)
    for q in asked:
        score = v @ v[q]
        want = [int(ids[i]) for i in np.lexsort((ids, -score)) if i != q][:20]
        hits += len({i for i, _ in got[int(ids[q])]} & set(want))
        assert len(got[int(ids[q])]) == 20
    assert len(got) == len(asked) and hits >= 0.9 * 20 * len(asked)


def test_labels_join_the_keys_of_texts_not_the_texts(spark, monkeypatch):
    """The sample with the labels apart is that of the joined table; texts
    are hashed below the join (before: they were shuffled for it, twice)."""
    from segmentflow.llm import language_id
    from segmentflow.llm.common import staged

    rows = [(i % 900, f"text {i} " * (i % 7)) for i in range(1000)] + [(None, "no key"), (5, None), (2000, "no label")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").where("text is not null")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)] + [(7, 0), (7, 1), (None, 1), (3000, 1)], "doc_id long, toxic int")
    plans = []

    def recorded(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return staged(df, name)

    monkeypatch.setattr(language_id, "staged", recorded)
    apart = language_id.bounded_sample(docs, "doc_id", "toxic", 100, groups=labels.distinct())
    below = plans[0][1].split("Join Inner")[1]
    assert plans[0][0] == "sample-keys" and "xxhash64(text" in below and "xxhash64(text" not in plans[0][1].split("Join Inner")[0]
    joined = language_id.bounded_sample(docs.join(labels.distinct(), "doc_id"), "doc_id", "toxic", 100)
    key = lambda r: (r.doc_id, r.text, r.toxic)
    assert sorted(map(key, apart.collect())) == sorted(map(key, joined.collect())) and joined.count() > 150


def test_words_are_learnt_in_bounded_parts(monkeypatch):
    """Before: all new words of a slice at once, some 250 MB a worker."""
    from segmentflow.llm import language_id

    logits = np.random.default_rng(1).normal(size=(1 << language_id.BITS, 3)).astype(np.float32)
    words = [f"w{i}x" for i in range(10_000)]
    most, plain = [], language_id.hashed_ngrams
    monkeypatch.setattr(language_id, "hashed_ngrams", lambda w, *a: (most.append(len(w)), plain(w, *a))[1])
    scorer = language_id.Scorer({"logits": logits, "languages": ["a", "b", "c"]})
    label, score = scorer([" ".join(words), " ".join(words[:50]), "w1x"])
    assert max(most) <= 4096 and len(score) == 3
    for text, got in zip((words, words[:50], ["w1x"]), score, strict=True):
        buckets, _ = plain(text, language_id.SIZES, language_id.BITS)
        assert abs(got - language_id._softmax(logits[buckets].astype(float).mean(axis=0)[None])[0].max()) < 1e-6


@pytest.mark.parametrize(("n", "trees", "bits", "enough"), [(1500, 32, 16, 300), (700, 8, 20, 5), (3, 8, 7, 9)])
def test_forest_finds_the_rows_below_the_prefixes_by_bitmaps(monkeypatch, n, trees, bits, enough):
    """Before: the places of every tree were put together for every query
    and depth tried."""
    from segmentflow.llm import lsh_forest

    rng = np.random.default_rng(n)
    v, q = rng.normal(size=(n, 12)), rng.normal(size=(400, 12))
    longest = float(np.sqrt((v**2).sum(axis=1)).max())
    forest = lsh_forest.Forest(v, longest, trees, bits)
    joined, plain = [], np.concatenate
    monkeypatch.setattr(lsh_forest.np, "concatenate", lambda *a, **k: (joined.append(1), plain(*a, **k))[1])
    got = dict(forest.candidates(q, enough))
    monkeypatch.undo()
    assert sorted(got) == list(range(400)) and (n < 1000 or len(joined) < 100)
    lift = np.sqrt(np.maximum(longest**2 - (v**2).sum(axis=1), 0))
    sign = lambda x: (x.astype(np.float32) @ forest.directions >= 0).reshape(len(x), trees, bits)
    rows = sign(np.column_stack([v, lift]) / longest)
    asked = sign(np.column_stack([q / np.sqrt((q**2).sum(axis=1, keepdims=True)), np.zeros(len(q))]))
    for i in range(0, 400, 7):
        same = np.cumprod(rows == asked[i], axis=2).sum(axis=2).max(axis=1)  # the longest prefix shared in any tree
        depth = next(d for d in range(bits, -1, -1) if d == 0 or (same >= d).sum() >= enough)
        assert np.array_equal(got[i], np.flatnonzero(same >= depth))


def test_workers_get_small_batches_and_keep_no_tables_of_others(spark):
    """Before: 10,000 rows or 64 MB at once, and what another operator had
    kept stayed in the worker beside the next one's joins."""
    import pyarrow as pa
    from pyspark.sql import types as T

    from segmentflow.llm import common

    def factory():
        return lambda texts: [[pa.total_allocated_bytes() for _ in texts]]

    docs = spark.range(64, numPartitions=1).select("id", F.repeat(F.lit("some words "), 50_000).alias("text"))
    held = common.append_columns(docs, "text", [T.StructField("held", T.LongType())], factory, ["id"])
    assert held.count() == 64 and held.agg(F.max("held")).first()[0] < 4 * common.BATCH_BYTES

    def kept(batches):
        yield from ()
        common.worker_kept("templates", 0, lambda: "tables")

    def left(batches):
        import sys

        for batch in batches:
            yield batch.set_column(1, "kept", pa.array(["_segmentflow_worker" in sys.modules] * batch.num_rows))

    one = spark.range(1, numPartitions=1).select("id", F.lit("a").alias("text"))
    one.mapInArrow(kept, "id long, text string").collect()
    common.append_columns(one, "text", [T.StructField("n", T.LongType())], factory, ["id"]).collect()
    assert not one.mapInArrow(left, "id long, kept boolean").first().kept


def test_token_store_workers_get_small_batches_and_give_memory_back(spark, tmp, monkeypatch):
    """Before: 10,000 rows or 64 MB at once, the tokenizer's tables stayed
    beside the reader, and a file's documents came as one batch of rows."""
    import public_tokenizers
    import pyarrow as pa

    from segmentflow.llm import common, decontaminate, pii, token_store

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.range(300, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    steps = {
        "tokens": lambda: token_store.write_sequences(docs, path, 2, folder=tmp + "/tokens", length=64),
        "templates": lambda: decontaminate.template_windows(docs, "doc_id", "text"),
        "personal data": lambda: pii.train(docs),
    }
    made = {}
    for name, step in steps.items():
        spark.conf.unset(key)
        made[name] = step()
        assert spark.conf.get(key) == f"{common.BATCH_BYTES}b", name

    monkeypatch.setattr(token_store, "READ_ROWS", 100)
    read = token_store.read_documents(made["tokens"].repartition(1))

    def left(batches):
        import sys

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(["_segmentflow_worker" in sys.modules])], names=["kept"])

    rows = read.collect()
    assert sorted(r.doc_id for r in rows) == list(range(300)) and {r.n_tokens for r in rows} == {3}
    assert sorted(r.start for r in rows) == list(range(0, 900, 3))
    assert not any(r.kept for r in spark.range(1, numPartitions=1).mapInArrow(left, "kept boolean").collect())
