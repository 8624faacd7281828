"""The training-data operators against brute force on small rows, with nulls, ties, repeats, empty tables and odd columns."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import (
    blocks,
    bpe,
    exact_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    pii,
    quality_classifier,
    quality_rules,
    token_counts,
    toxicity,
)
from feedloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def random_docs(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["Äpfel", "日本", "naïve", "don't", "x" * 40]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.randrange(0, 60))), r.choice(["en", "de", None]), f"src{i % 5}", 0) for i in range(n)]
    rows += [(n, None, None, None, None), (n + 1, "", "en", "src0", 0), (n + 2, " \t\n ", "en", "src1", 0), (None, "w1 w2 w3 w4 w5", "en", "src2", 3)]
    rows += [(n + 3, rows[3][1] + "  ", "en", "src1", 1), (n + 4, "\n".join(["same line here"] * 9), "en", "src1", 1), (5, rows[5][1], "en", "src0", 0)]
    rows += [(n + 5, "w1 " * 5000, "en", "src0", 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(random_docs(), SCHEMA).repartition(3, "source").cache()


@pytest.fixture(scope="module")
def clashing(docs):
    """The same rows with columns named like the operators' own ones."""
    names = ["text_sha256", "keep_id", "n_tokens", "id", "digest", "kept", "block", "share", "budget", "kind", "meta", "content", "r_bin", "base", "reference"]
    return docs.withColumns({n: F.lit("x") for n in names})


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


RUNS = {
    "bpe": lambda d: bpe.round_trip(d),
    "pii": lambda d: pii.pii(d),
    "token_counts": lambda d: token_counts.length_histogram(d),
    "quality_rules": lambda d: quality_rules.quality(d),
    "quality_classifier": lambda d: quality_classifier.quality_scores(d, labels_of(d, "quality")),
    "mixing": lambda d: mixing.mix(d),
    "near_dedup": lambda d: near_dedup.near_dedup(d),
    "lm_scoring": lambda d: lm_scoring.lm_scores(d),
    "exact_dedup": lambda d: exact_dedup.exact_dedup(d),
    "toxicity": lambda d: toxicity.toxicity(d, toxicity.fit(d, labels_of(d, "toxic"))),
}


def labels_of(d, name):
    return d.sparkSession.createDataFrame([(i, i % 3 % 2) for i in range(50)] + [(None, 1), (7, None), (999, 1)], f"doc_id long, {name} int")


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_table(spark, name):
    assert RUNS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", sorted(RUNS))
def test_other_columns_change_nothing_and_rows_stay(docs, clashing, name):
    a, b = RUNS[name](docs), RUNS[name](clashing)
    assert a.columns == b.columns
    if name != "token_counts":
        assert a.count() == b.count() == docs.count()
    if name not in ("lm_scoring", "quality_classifier", "toxicity"):
        assert by_id(a) == by_id(b)


# Byte and word blocks


def test_words_and_shingles_equal_brute_force(docs):
    import pyarrow as pa

    texts = [r["text"] for r in docs.collect()]
    for size in (1, 50, 1 << 20):
        counts, sets = [], []
        for block in blocks.texts(pa.array(texts), size):
            found = blocks.words(block)
            counts += (found.of[1:] - found.of[:-1]).tolist()
            values, edge = blocks.distinct(*blocks.shingles(blocks.word_hashes(block, found), found.of, 4))
            sets += [frozenset(values[a:b].tolist()) for a, b in zip(edge[:-1], edge[1:])]
        split = [WORDS.findall(t or "") for t in texts]
        assert counts == [len(w) for w in split]
        plain = [frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset() for w in split]
        assert [len(s) for s in sets] == [len(s) for s in plain]
        for i, j in itertools.combinations(range(len(sets)), 2):
            assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])


# 1


def test_bpe_equals_the_library_and_mends_words(docs):
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path()
    known, own = Tokenizer.from_file(path), bpe.Codec(path)
    r = random.Random(5)
    letters = "ab'st  \n\t\x1c\x85\xa0　éß中1²½<|endoftext|>!?.…😀‍ſwhereing"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(30))) for _ in range(2000)] + ["<|endoftext|>", "a<|endoftext|> b", "the" * 3000]
    expected = [known.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(own.encode_batch(texts)) == expected
    assert 0 < own.mended < own.speculated
    assert all(own.decode(x) == known.decode(x, skip_special_tokens=False) for x in expected)
    for r_ in bpe.decode(bpe.encode(docs)).join(docs.select("doc_id", F.col("text").alias("t")), "doc_id").collect():
        assert r_["text"] == (r_["t"] or "")
    for row in bpe.round_trip(docs).filter("doc_id < 20").collect():
        text = next(x[1] for x in random_docs() if x[0] == row["doc_id"])
        ids = known.encode(text, add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids) and row["round_trip"]
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# 2

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_base_equals_brute_force_and_wider_spans_are_added(spark):
    r = random.Random(2)
    pieces = ["a.b@c.de", "x@y.z_q@r.s.t", "@", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "+1 (555) 123-4567", "+49.30.1234567 ", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "😀", "ß", " ", "\n", "12345678901234567890", "text", "+"]
    rows = [(i, "".join(r.choice(pieces) for _ in range(r.randrange(1, 14)))) for i in range(300)]
    rows += [(1000 + i, f"contact us by mail at {n}@example.com or card 4111111111111111, token = \"{'ab12' * 8}\" ok") for i, n in enumerate("abcdefgh")]
    rows += [(2000, None), (2001, "a" * 50_000 + "@"), (None, "x@y.zz")]
    found = pii.pii(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = dict(rows)
    for row in found.collect():
        expected = base_spans(texts[row["doc_id"]] or "")
        assert row["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest(), (texts[row["doc_id"]], row["spans"], expected)
        assert [s for s in row["spans"].split(",") if s.split(":")[0] in BASE] == [s for s in expected.split(",") if s] or not expected
        assert sum(row[f"n_{k}"] for k in BASE) == len([s for s in expected.split(",") if s])
    assert found.filter("doc_id between 1000 and 1999 and n_more = 1 and spans like '%secret:%'").count() == 8
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_pii_of_a_text_with_very_many_hits(spark):
    text = "a.b@c.de 1.2.3.4 " * 20_000
    (row,) = pii.pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (row["n_email"], row["n_ip"], row["n_spans"]) == (20_000, 20_000, 40_000)
    assert row["base_sha256"] == hashlib.sha256(base_spans(text).encode()).hexdigest()


# 3


def test_length_histogram_answers_for_every_limit(docs):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(bpe.vocabulary_path())
    lengths = sorted(len(known.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect())
    histogram = token_counts.length_histogram(docs).cache()
    for row in histogram.collect():
        n = row["n_tokens"]
        assert row["n_docs"] == lengths.count(n) and row["docs_upto"] == sum(x <= n for x in lengths)
        assert row["docs_from"] == sum(x >= n for x in lengths) and row["tokens_from"] == sum(x for x in lengths if x >= n)
        assert row["truncated_total"] == sum(min(x, n) for x in lengths) and row["tokens_total"] == sum(lengths)
    limits = [0, 1, 17, 100, 10**6]
    assert {r["context_limit"]: r["total"] for r in token_counts.truncated_totals(histogram, limits).collect()} == {x: sum(min(y, x) for y in lengths) for x in limits}
    assert token_counts.quantiles(histogram, [0.5]).first()["n_tokens"] == lengths[math.ceil(len(lengths) / 2) - 1]
    assert token_counts.length_histogram(docs, group_cols=["lang"]).agg(F.sum("n_docs")).first()[0] == len(lengths)


# 4


def test_quality_measures_equal_brute_force(spark, docs):
    junk = [(500, " ".join(["#$%&|<>"] * 200), "en", "s", 0), (501, "\n\n a\r\n a\r\n\n a", "en", "s", 0)]
    rows = quality_rules.quality(docs.unionByName(spark.createDataFrame(junk, SCHEMA)).dropDuplicates(["doc_id"])).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()} | {j[0]: j[1] for j in junk}
    for row in rows:
        text = texts[row["doc_id"]]
        words = WORDS.findall(text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        counts = collections.Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        expected = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert tuple(row)[1:6] == expected
        assert row["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (row["base_failed"] and row["kept"])
    assert quality_rules.distance(__import__("numpy").array([[4, 0], [0, 4], [2, 2]]), __import__("numpy").array([1, 0])).round(3).tolist() == [0, 1, 0.558]


# 5 and 10


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(3)
    rows, marks = [], []
    for i in range(600):
        words = r.choices([f"word{k}" for k in range(200)], k=60)
        bad, toxic = i % 5 == 0, i % 7 == 0
        if toxic:
            words[r.randrange(60)] = r.choice(["vilest", "vilesty", "rotter"])
            words[r.randrange(60)] = "rotter"
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)
        rows.append((i, text, "en", f"src{i % 4}", len(text)))
        if i < 400:
            marks.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_co_training_scores_held_out_documents(labelled):
    scored = quality_classifier.quality_scores(*labelled).collect()
    assert all(row["kept"] == (row["doc_id"] % 5 != 0) for row in scored)
    assert all(0 <= row[c] <= 1 for row in scored for c in ("content_score", "metadata_score", "score"))


def test_no_labels_of_both_kinds(spark, labelled):
    docs, _ = labelled
    good = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r["score"] for r in quality_classifier.quality_scores(docs, good).collect()} == {1.0}
    none = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {(r["severity"], r["toxic"]) for r in toxicity.toxicity(docs, toxicity.fit(docs, none)).collect()} == {(0.0, False)}


def test_toxic_documents_are_found_and_clean_ones_left_alone(labelled):
    docs, marks = labelled
    model = toxicity.fit(docs, marks)
    assert list(model.thetas) == sorted(model.thetas)
    scored = toxicity.toxicity(docs, model).collect()
    assert all(row["toxic"] == (row["doc_id"] % 7 == 0) for row in scored)
    assert all(0 <= row["severity"] <= 3 for row in scored)
    assert toxicity.without_toxic(docs, model).columns == docs.columns


def test_toxic_features_are_counted_on_all_labelled_documents(labelled):
    docs, marks = labelled
    whole, small = toxicity.fit(docs, marks), toxicity.fit(docs, marks, sample=40)
    assert len(whole.keys) and small.keys.tolist() == whole.keys.tolist()
    texts = {r["doc_id"]: r["text"].lower() for r in docs.collect()}
    flags = {r["doc_id"]: r["toxic"] for r in marks.collect()}
    counts = {k: [0, 0] for k in whole.keys.tolist()}
    import pyarrow as pa

    for i, flag in flags.items():
        (block,) = blocks.texts(pa.array([texts[i]]))
        for key in {k for keys, _ in toxicity.features(block) for k in keys.tolist()} & counts.keys():
            counts[key][1 - flag] += 1
    t, c = sum(flags.values()), len(flags) - sum(flags.values())
    for a, b in counts.values():
        odds = math.log((a + 0.5) / (t - a + 0.5)) - math.log((b + 0.5) / (c - b + 0.5))
        assert a + b > 2 and abs(odds) >= 3 * math.sqrt(1 / (a + 0.5) + 1 / (t - a + 0.5) + 1 / (b + 0.5) + 1 / (c - b + 0.5))


@pytest.mark.parametrize("slots", [toxicity.SLOTS, 5000, 64, 1])
def test_labels_from_bit_tables_equal_the_join(spark, slots):
    docs = spark.range(5000).select(F.col("id"), F.lit("a").alias("text")).unionByName(spark.createDataFrame([(None, "b"), (7, "c"), (7, "c"), (8, "d")], "id long, text string"))
    ids = docs.select("id").dropna().distinct().selectExpr("id", "CASE WHEN id % 7 = 0 THEN 1 WHEN id % 3 = 0 THEN 0 END AS toxic")
    expected = docs.join(ids.dropna(), "id").select("id", "text", "toxic")
    assert by_id(toxicity._labelled(docs, ids, slots)) == by_id(expected)
    assert by_id(toxicity._labelled(docs, ids.filter("id < 0"), slots)) == []


def test_features_beyond_the_limit_are_reported(labelled):
    docs, marks = labelled
    whole = toxicity.fit(docs, marks)
    few = toxicity.fit(docs, marks, most=3)
    assert whole.dropped == 0 and len(few.keys) == 3 and few.dropped == len(whole.keys) - 3


def test_toxic_sample_is_of_present_documents_and_one_row_of_each(spark, labelled):
    docs, marks = labelled
    absent = spark.range(1000, 40_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    model = toxicity.fit(docs, marks.unionByName(absent), sample=400)
    assert model.thetas is not None and model.thetas.tolist() == toxicity.fit(docs, marks, sample=400).thetas.tolist()
    rows = docs.filter("doc_id < 20").selectExpr("doc_id AS id", "text", "1 AS toxic")
    hot = rows.unionByName(rows.filter("id = 7").selectExpr("id", "explode(array_repeat(text, 500)) AS text", "toxic"))
    finder = toxicity.Finder(model.keys)
    one = {r["id"]: r["found"] for r in toxicity._found(rows, finder).collect()}
    got = toxicity._found(hot, finder).collect()
    assert len(got) == len(one) == 20 and all(r["found"] == one[r["id"]] for r in got)


# 6


def shares(children, budget):
    """Whole tokens by weight, capped; the rest to the siblings."""
    order = sorted((c for c in children if c[1] > 0), key=lambda c: (c[2] / c[1], c[0] or ""))
    out, left, weights = {c[0]: 0 for c in children}, budget, sum(c[1] for c in children)
    for k, (name, weight, cap) in enumerate(order):
        if cap * weights <= left * weight:
            out[name], left, weights = cap, left - cap, weights - weight
        else:
            for name, weight, _ in order[k:]:
                out[name] = left * weight // weights
            break
    return out


def test_budgets_go_to_siblings_first(spark):
    rows = [(d, lang, s, t) for d, lang, s, t in [
        ("a", "en", "s1", 100), ("a", "en", "s2", 10), ("a", "de", "s3", 50), ("b", "en", "s4", 1000), ("b", None, "s5", 7), (None, "en", None, 30)]]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    weights = {("a",): 3, ("b",): 1, ("a", "en"): 2, ("a", "en", "s2"): 5, ("b", None): 4}
    for budget, epochs in ((60, 1), (400, 2), (10_000, 1), (0, 1), (137, 3)):
        got = {tuple(r)[:3]: r["share"] for r in mixing.leaf_shares(leaves, F.lit(budget).cast("long"), weights, 1, epochs).collect()}

        def split(paths, total, level):
            groups = collections.defaultdict(list)
            for p in paths:
                groups[p[level]].append(p)
            caps = [(name, weights.get((*ps[0][:level], name), 1), sum(p[3] for p in ps) * epochs) for name, ps in groups.items()]
            for name, share in shares(caps, total).items():
                if level == 2:
                    assert got[groups[name][0][:3]] == share, (budget, name)
                else:
                    split(groups[name], share, level + 1)

        split(rows, budget, 0)


def test_mix_takes_prefixes_of_seeded_epochs(docs):
    unique = docs.dropDuplicates(["doc_id"])
    for percent, epochs in ((50, 1), (180, 3)):
        got = mixing.mix(unique, percent=percent, max_epochs=epochs).collect()
        total = sum(r["tokens"] for r in got)
        assert sum(r["tokens"] * r["copies"] for r in got) <= total * percent // 100
        leaves = collections.defaultdict(list)
        for r in got:
            leaves[r["domain"], r["lang"], r["source"]].append(r)
        for rows in leaves.values():
            low = min(r["copies"] for r in rows)
            assert {r["copies"] for r in rows} <= {low, low + 1}
            order = sorted(rows, key=lambda r: (int(hashlib.md5(f"17:{low}:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:15], 16)))
            taken = [r["copies"] > low for r in order]
            assert taken == sorted(taken, reverse=True)
    assert "Python" not in mixing.mix(unique)._jdf.queryExecution().executedPlan().toString()


# 7


def brute_components(rows, width=4, percent=80):
    sets = {}
    for i, text, *_ in rows:
        if i is not None:
            w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
            sets.setdefault(i, set()).add(frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(sorted(sets), 2):
        if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i in sets}


def test_near_dedup_equals_brute_force_with_chains_and_large_groups(spark):
    r = random.Random(4)
    rows = random_docs(7, 40)
    base = [f"t{k}" for k in range(80)]
    for i in range(150):  # copies that drift: neighbours are linked, ends are not
        if i % 5 == 4:
            base[r.randrange(80)] = f"n{i}"
        rows.append((1000 + i, " ".join(base), "en", "s", 0))
    for i in range(60):  # one passage in otherwise different texts
        rows.append((2000 + i, " ".join([f"p{k}" for k in range(40)] + [f"q{i}_{k}" for k in range(r.randrange(0, 30))]), "en", "s", 0))
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = near_dedup.near_dedup(docs).collect()
    expected = brute_components(rows)
    assert len(got) == len(rows)
    for row in got:
        assert row["component_id"] == expected.get(row["doc_id"])
        assert row["kept"] == (row["doc_id"] is None or row["doc_id"] == row["component_id"])


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200 + i: 200 for i in range(9)}


# 8


def test_lm_base_score_equals_brute_force_and_the_model_is_a_distribution(spark, docs):
    rows = docs.collect()
    got = lm_scoring.lm_scores(docs).collect()

    def tokens(text):
        return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]

    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    counts = collections.Counter(t for r in rows if not held(r["doc_id"]) for t in tokens(r["text"]))
    total, different = sum(counts.values()), len(counts)
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert len(got) == len(rows)
    for row in got:
        mine = tokens(texts[row["doc_id"]])
        score = sum(math.log10((counts[t] + 1) / (total + different + 1)) for t in mine)
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held(row["doc_id"]), len(mine), total)
        assert row["n_known"] == sum(counts[t] > 0 for t in mine) and abs(row["base_score"] - score) < 1e-6 * max(1, abs(score))
        assert abs(row["score"] - brute_ctw(rows, held, texts[row["doc_id"]])) < 1e-6 * max(1, abs(row["score"])) if row["n_bytes"] < 120 and row["n_bytes"] % 5 == 0 else True


_ctw = {}


def brute_ctw(rows, held, text):
    """Context-tree weighting by its recursion, one node at a time."""
    lower = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()) + b"\xff"
    if not _ctw:
        counts, kids = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)
        for r in rows:
            data = b"\0" * 4 + lower(r["text"])
            for i in range(4, len(data)):
                for d in range(5):
                    for k in range(8):
                        node = (data[i - d : i], 1 << k | data[i] >> (8 - k))
                        if not held(r["doc_id"]):
                            counts[node][data[i] >> (7 - k) & 1] += 1
                        if d:
                            kids[data[i - d + 1 : i], node[1]].add(node)
        _ctw["n"], _ctw["kids"], _ctw["w"] = counts, kids, {}

    def weighted(node):
        if node not in _ctw["w"]:
            a, b = _ctw["n"][node]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            below = sum(weighted(x) for x in _ctw["kids"][node]) if len(node[0]) < 4 else None
            mixed = own if below is None else max(own, below) + math.log1p(math.exp(-abs(own - below))) - math.log(2)
            _ctw["w"][node] = mixed, (1.0 if below is None else 1 / (1 + math.exp(min(700, below - own))))
        return _ctw["w"][node][0]

    data, score = b"\0" * 4 + lower(text), 0.0
    for i in range(4, len(data)):
        for k in range(8):
            p, rest = 0.0, 1.0
            for d in range(5):
                node = (data[i - d : i], 1 << k | data[i] >> (8 - k))
                weighted(node)
                a, b = _ctw["n"][node]
                share = _ctw["w"][node][1]
                p += rest * share * (b + 0.5) / (a + b + 1)
                rest *= 1 - share
            score += math.log10(p if data[i] >> (7 - k) & 1 else 1 - p)
    return score


# 9


def test_exact_dedup_equals_brute_force(docs):
    rows = docs.collect()
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = collections.defaultdict(list)
    for r in rows:
        groups[normal(r["text"])].append(r["doc_id"])
    texts = collections.defaultdict(set)
    for r in rows:
        texts[r["doc_id"]].add(normal(r["text"]))
    for row in exact_dedup.exact_dedup(docs).collect():
        (text,) = texts[row["doc_id"]]
        ids = [i for i in groups[text] if i is not None]
        keep = min(ids) if ids else None
        assert (row["keep_id"], row["group_size"], row["kept"]) == (keep, len(groups[text]), row["doc_id"] == keep)
        assert row["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert exact_dedup.deduped(docs).columns == docs.columns


def test_cuckoo_index_inserts_deletes_and_grows():
    index = exact_dedup.CuckooIndex(2)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, key in enumerate(keys):
        assert index.find(key) is None
        index.insert(key, [1, i, 1])
    assert index.resized > 3 and all(index.find(k)[1] == i for i, k in enumerate(keys))
    for key in keys[::2]:
        assert index.delete(key) and not index.delete(key)
    assert all(index.find(k) is None for k in keys[::2]) and all(index.find(k) for k in keys[1::2]) and len(index) == 1500


def test_index_tables_take_in_and_forget(spark, docs):
    rows = exact_dedup.digests(docs)
    index = exact_dedup.build_index(rows, 3)
    texts = index.count()
    more = exact_dedup.insert(index, rows, 4)
    assert more.count() == texts and more.agg(F.sum("group_size")).first()[0] == 2 * docs.count()
    gone = index.limit(5).select("digest").collect()
    kept = exact_dedup.delete(index, spark.createDataFrame([(r["digest"],) for r in gone] + [(b"?",), (None,)], "digest binary"), 3)
    assert kept.count() == texts - 5


def test_wide_signature_takes_four_bits_of_an_evaluation():
    values = near_dedup.blocks.stream(5, 40)
    whole, bits = near_dedup.signature(values, near_dedup.np.array([0, 15, 15, 40]), 2, 64)
    assert bits.shape == (3, 2) and not bits[1].any() and not whole[1].any()
    odd = near_dedup.blocks.stream(11, 65) | near_dedup.np.uint64(1)
    for row, part in ((0, values[:15]), (2, values[15:])):
        for k in (2, 31):
            hashed = part * odd[k]
            low = hashed.astype(near_dedup.np.uint32)
            wanted = [int(near_dedup.blocks.mix(x)) & 1 for x in (hashed.min(), hashed.max(), low.min(), low.max())]
            place = 4 * k
            assert [int(bits[row, place // 64]) >> (place % 64 + i) & 1 for i in range(4)] == wanted
