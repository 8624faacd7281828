"""Packing, alignment and spelling variants against brute force, on odd rows and on the documents of the smallest scale."""

import collections
import hashlib
import json
import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import alignment, blocks, packing, queries, spelling
from feedloom.llm.bpe import byte_letters
from feedloom.llm.words import Known

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


def odd_texts(seed=5):
    r = random.Random(seed)
    words = ["the", "The", "naïve", "don't", "it's", "日本語", "x" * 70, "éa", "́x", "≠", "İstanbul", "ΣΑΣ", "a b", "<|endoftext|>", "<s>", "12345", "a1,b2.", "(x)", "I'll", "='s", "e\u0301.", "=\u0338", "C++", "http://a.b/c?d=e", "THE", "<|STARTOFTEXT|>", "　", "\x1c", "\x85", "🙂"]
    gaps = [" ", "  ", "\n", "\t", " \n ", " ", "  ", "  ", "\x0b", "\x0c", "\r\n", "   "]
    texts = ["".join(r.choice(words) + r.choice(gaps) for _ in range(r.randrange(1, 60))) for _ in range(40)]
    texts += [None, "", " ", "   ", "\n", "a", " a", "a ", "  a  ", "a▁b", "x y ▁", "\u0000 b", "w " * 9000, "y" * 30000, "tail ", "     z"]
    return texts


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(odd_texts())]
    rows += [(None, "a null id here", None, None, None), (3, rows[3][1], "en", "s", 0), (3, "another text of this id", "en", "s", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def clashing(docs):
    names = ["id", "block", "part", "row", "n", "ids", "tail", "blob", "word", "number", "salt", "group", "tokens", "value", "firsts"]
    return docs.withColumns({name: F.lit("x") for name in names})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- packing ----------------------------------------------------------------------------------------------------------


def check_packing(docs, size):
    pieces = packing.pack(docs, size=size).collect()
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = collections.Counter((r.doc_id, tuple(coder.encode(r.text or "", add_special_tokens=False).ids) + (1,)) for r in docs.collect())
    sequences = collections.defaultdict(list)
    by_doc = collections.defaultdict(list)
    for p in pieces:
        assert 1 <= p.length <= size and len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append((p.offset, p.length))
        ids = tuple(int.from_bytes(p.ids[k : k + 4], "little") for k in range(0, len(p.ids), 4))
        by_doc[p.doc_id, p.doc_tokens].append((p.start, ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or at & (at - 1) == 0
    assert sum(1 for parts in sequences.values() if sum(n for _, n in parts) < size) < size.bit_length()
    assert sorted(sequences) == list(range(len(sequences)))
    return expected, by_doc


@pytest.mark.parametrize("size", [16, 64, 2048])
def test_pack_holds_each_id_once_without_padding(odd, size):
    unique = odd.filter("doc_id is not null and doc_id <> 3")
    expected, by_doc = check_packing(unique, size)
    found = {(doc, sum((ids for _, ids in sorted(parts)), ())) for (doc, _), parts in by_doc.items()}
    assert found == set(expected)
    for parts in by_doc.values():
        at = 0
        for start, ids in sorted(parts):
            assert start == at
            at += len(ids)


def test_pack_null_and_repeated_ids(odd):
    expected, by_doc = check_packing(odd, 32)
    total = sum(len(ids) * n for (_, ids), n in expected.items())
    assert total == sum(len(ids) for parts in by_doc.values() for _, ids in parts)
    assert (None, len(next(ids for doc, ids in expected if doc is None))) in by_doc


def test_pack_clashing_columns_and_empty_table(odd, spark):
    assert len(rows_of(packing.pack(clashing(odd), size=64))) == len(rows_of(packing.pack(odd, size=64)))
    assert packing.pack(odd.limit(0)).collect() == []


def test_pack_blocks_share_ranks(odd, monkeypatch):
    monkeypatch.setattr(packing, "RANGE", 2)
    monkeypatch.setattr(packing, "BLOCK", 50)
    check_packing(odd.repartition(7), 64)


@pytest.mark.parametrize("seed", range(30))
def test_plan_against_single_packs(seed):
    """The ranges of packs hold just what packs taken one by one would."""
    r = random.Random(seed)
    size = r.choice([8, 16, 33, 100])
    histogram = {r.randrange(1, size): r.randrange(1, 30) for _ in range(r.randrange(1, 12))}
    made = packing.plan(histogram, size)
    filled = collections.defaultdict(list)
    for length, count in histogram.items():
        for rank in range(count):
            at = 0
            for start, much, sequence, offset in made.pieces(length, rank):
                assert start == at and much > 0
                at += much
                filled[sequence].append((offset, much))
            assert at == length
    odd_ones = 0
    for parts in filled.values():
        at = 0
        for offset, much in sorted(parts):
            assert offset == at
            at += much
        odd_ones += at != size
        assert at == size or at & (at - 1) == 0
    total = sum(k * n for k, n in histogram.items())
    assert len(filled) == made.sequences == total // size + bin(total % size).count("1")
    assert odd_ones == bin(total % size).count("1")


def test_plan_places_longest_first_into_the_most_room():
    made = packing.plan({7: 1, 5: 1, 3: 1, 2: 1}, 10)
    # 7 and 5 open packs; 3 goes to the one of 5 (more room), then 2 to the one of 7 (3 left against 2).
    assert made.taken[7][0] == (0, 0, 0) and made.taken[5][0] == (0, 1, 0)
    assert made.taken[3][0] == (0, 1, 5) and made.taken[2][0] == (0, 0, 7)


# -- alignment --------------------------------------------------------------------------------------------------------


def brute_alignment(rows):
    a_coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_letters()
    vocabulary = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))["model"]["vocab"]
    a_bytes = {i: bytes(letters.get(c, 0) for c in t) for t, i in vocabulary.items()}

    def b_bytes(i):
        piece = b_coder.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_coder.is_byte(i) else piece.replace("▁", " ").encode()

    links, shown = [], []
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_coder.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
            links.append(None)
            shown.append((0, 0, 0, 0, ""))
            continue
        ends = []
        for ids, sizes in ((a, a_bytes.__getitem__), (b, b_bytes)):
            at, mine = 0, []
            for i in ids:
                at += len(sizes(i))
                mine.append(at)
            ends.append(mine)
        marks = sorted(set(ends[0]) & set(ends[1]))
        group = lambda end: next(k for k, m in enumerate(marks) if end <= m) if len(marks) < 50 else __import__("bisect").bisect_left(marks, end)
        in_a, in_b = collections.defaultdict(list), collections.defaultdict(list)
        for i, end in zip(a, ends[0]):
            in_a[group(end)].append(i)
        for i, end in zip(b, ends[1]):
            in_b[group(end)].append(i)
        mine = collections.Counter((x, y) for g in range(len(marks)) for x in in_a[g] for y in in_b[g])
        text_form = ";".join(",".join(map(str, in_a[g])) + "|" + ",".join(map(str, in_b[g])) for g in range(len(marks)))
        links.append(mine)
        shown.append((len(a), len(b), len(marks), sum(mine.values()), hashlib.sha256(text_form.encode()).hexdigest()))
    count = collections.Counter(p for m in links if m for p in m)
    most = collections.defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, _), m, s in zip(rows, links, shown):
        m = m or {}
        best = sum(n for (x, y), n in m.items() if count[x, y] == most[x])
        out.append((doc, *s[:4], best, sum(n * count[p] for p, n in m.items()), s[4]))
    return sorted(out, key=repr), {(x, y, n, n == most[x]) for (x, y), n in count.items()}


@pytest.mark.parametrize("fan", [2, 256])
def test_alignment_against_brute_force(odd, fan, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 3000)
    expected, pairs = brute_alignment([(r.doc_id, r.text) for r in odd.collect()])
    assert rows_of(alignment.alignment(odd, fan=fan)) == expected
    assert {tuple(r) for r in alignment.pair_counts(odd, fan=fan).collect()} == pairs


def test_alignment_of_documents(spark):
    docs = queries.table(spark, SMALL, "documents")
    expected, _ = brute_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(queries.QUERIES["op12_alignment"](spark, SMALL)) == expected


def test_alignment_clashing_columns_and_empty_table(odd):
    few = odd.filter("doc_id < 12")
    assert rows_of(alignment.alignment(clashing(few))) == rows_of(alignment.alignment(few))
    assert alignment.alignment(odd.limit(0)).collect() == []


def test_merged_runs():
    import numpy as np

    r = random.Random(2)
    runs = [sorted(r.sample(range(40), r.randrange(0, 20))) for _ in range(9)]
    blobs = [alignment._packed(np.array(x, np.int64), np.ones(len(x), np.int64)) for x in runs]
    pairs, counts = alignment.merged(blobs)
    assert dict(zip(pairs.tolist(), counts.tolist())) == collections.Counter(x for run in runs for x in run)
    assert pairs.tolist() == sorted(set(pairs.tolist()))


def test_known_forgets_without_changing_results():
    import numpy as np

    def look(known, words):
        raw = np.frombuffer(b"".join(words), np.uint8)
        edges = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        at = known(raw, edges[:-1], edges[1:], blocks.span_hashes(blocks.prefix_sums(raw), edges[:-1], edges[1:]))
        return [known.flat[known.edges[i] : known.edges[i + 1]].tolist() for i in at]

    tight = Known(lambda ws: (np.array([len(w) for w in ws]), np.frombuffer(b"".join(ws), np.uint8), None), limit=200)
    r = random.Random(1)
    for _ in range(30):
        words = [bytes(r.choices(b"abc", k=r.randrange(1, 5))) for _ in range(12)]
        assert look(tight, words) == [list(w) for w in words]


# -- spelling ---------------------------------------------------------------------------------------------------------


def brute_variants(rows, every=97, least=5, least_count=3):
    found = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    words = {w: n for w, n in found.items() if n >= least_count}
    letters = sorted({c for w in words for c in w})
    form, near = {}, {}
    for w, n in words.items():
        mine = {w[:i] + w[i + 1 :] for i in range(len(w))}
        mine |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        mine = {v for v in mine if v in words and v != w}
        near[w] = len(mine)
        best = min(mine, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], words.get(form[w])))
    return sorted(out, key=repr)


def spelled_rows(seed=3):
    r = random.Random(seed)
    base = ["hello", "helloo", "hellooo", "hallo", "Höllo", "hxllo", "ÀÁÂÃÄ", "ÀÁÂÃÄÄ", "aaaaa", "aaaaaa", "aaaaab", "abaaa", "×÷×÷×", "wordy", "words", "sword", "swords"]
    rows = []
    for i in range(60):
        words = r.choices(base, weights=[2 ** (k % 6) for k in range(len(base))], k=r.randrange(0, 40))
        rows.append((i, " ".join(words)))
    rows += [(None, "hello hello"), (None, None), (70, None), (71, ""), (72, "z" * 4000 + " " + "z" * 3999), (73, "z" * 4000 + "," + "z" * 4000), (74, "z" * 3999 + "1" + "z" * 3999), (5, rows[5][1])]
    return rows


@pytest.mark.parametrize("every", [97, 3])
def test_variants_against_brute_force(spark, every):
    rows = spelled_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    short = [x for x in brute_variants([x for x in rows if not (x[1] or "").startswith("zzz")], every)]
    found = rows_of(spelling.variants(docs, every=every))
    assert [x for x in found if not x[0].startswith("zzz")] == short
    if every == 97:
        longs = {x[0]: x for x in found if x[0].startswith("zzz")}
        assert sorted(map(len, longs)) == [3999, 4000] and all(x[4] == 1 for x in longs.values())


def test_variants_of_documents(spark):
    docs = queries.table(spark, SMALL, "documents")
    expected = brute_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(queries.QUERIES["op13_spelling"](spark, SMALL)) == expected


def test_variants_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame(spelled_rows()[:60], "doc_id long, text string")
    assert rows_of(spelling.variants(clashing(docs))) == rows_of(spelling.variants(docs))
    assert spelling.variants(docs.limit(0)).collect() == []


def test_roots_follow_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(13)] + [(100, 5), (200, 201)], "number long, form long")
    found = {r.number: r.root for r in spelling.roots(links).collect()}
    assert found == {**{i: 13 for i in range(13)}, 100: 13, 200: 201}


def test_variants_flushing_changes_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(spelled_rows()[:60], "doc_id long, text string").coalesce(1)
    whole = rows_of(spelling.variants(docs))
    monkeypatch.setattr(spelling, "HELD", 3)
    assert rows_of(spelling.variants(docs)) == whole


def test_op11_query_of_documents(spark):
    found = queries.QUERIES["op11_packing"](spark, SMALL).collect()
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: coder.encode(r.text or "", add_special_tokens=False).ids + [1] for r in queries.table(spark, SMALL, "documents").collect()}
    held = collections.Counter()
    for p in found:
        mine = ids[p.doc_id]
        assert p.doc_tokens == len(mine)
        part = b"".join(i.to_bytes(4, "little") for i in mine[p.start : p.start + p.length])
        assert zlib.crc32(part) == p.ids_crc32
        held[p.doc_id] += p.length
    assert held == {doc: len(mine) for doc, mine in ids.items()}
