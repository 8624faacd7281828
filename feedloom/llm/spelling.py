"""Spelling variant grouping (operator 13) by a trie-node pair dictionary.

Words are nodes of two tries: a prefix is a node of the forward one, a suffix a node of the one of reversed words. Both are numbered,
and a word is entered under integer pairs (prefix node, suffix node): with each of its positions *skipped*, and with each of its gaps
*open*. Two words that skip the same pair differ by one replaced code point there; one that skips and one that is open at the same
pair differ by one inserted code point. The tables meet on the pairs alone, and every edit distance of one is found once: an inserted
code point counts at the first place of a run of equal ones.

A node's number is a 64-bit hash of its string, so a number needs no table of nodes and no join: equal strings always have equal
numbers, and as a pair has 128 bits, other pairs practically never meet. A pair has at most one word per letter of the alphabet, and
one more: no group grows with the table. Each member of a pair takes the number of its partners and its best one there, so rows grow
with the letters of the words and not with the pairs of words.

Words are numbered in code-point order, so ties are decided by number. Roots are found by doubling the links from word to form.

Null texts have no runs. A null id counts as '' in ``<doc_id>:<run>``. Repeated rows count each time. Very long runs cost rows in
proportion to their length. An empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .shared import picked, stored

#: Letters of a run after A-Z are lower-cased; fixed values.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: Every so many values of the checksum a run loses a letter.
DAMAGE = 97
#: Different words that a map task counts before it sends them on, and letters of them.
HELD, HELD_LETTERS = 200_000, 1 << 24


def damaged(run: str, seed: int, every: int = DAMAGE) -> str:
    """The run, without one code point if its checksum says so; ``seed`` is the checksum of what stands before it."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(docs: DataFrame, every: int = DAMAGE, least: int = LEAST_LETTERS) -> DataFrame:
    """Rows (id, text) to (word, n), counted in the map tasks already."""

    def flushed(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, letters = Counter(), 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                # Bytes know the case of ASCII letters only.
                runs = Counter(RUN.findall(text.as_py().encode().lower().decode()))
                seed = zlib.crc32(f"{doc.as_py()}:".encode() if doc.is_valid else b":")
                for word, n in runs.items():
                    if not zlib.crc32(word.encode(), seed) % every:
                        word = damaged(word, seed, every)
                    if len(word) >= least:
                        letters += len(word)
                        found[word] += n
                if len(found) > HELD or letters > HELD_LETTERS and sum(map(len, found)) > HELD_LETTERS:
                    yield flushed(found)
                    found, letters = Counter(), 0
        if found:
            yield flushed(found)

    return docs.select(F.col("id").cast("string").alias("id"), "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def node_pairs(words: DataFrame) -> DataFrame:
    """Rows (number, word, n) to (prefix, suffix, number, n, open, first): ``open`` at a gap; ``first`` if the skipped letter differs from the one before."""
    names = ["prefix", "suffix", "number", "n", "open", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, n = (batch.column(k).to_numpy() for k in (0, 2))
            for block in blocks.texts(batch.column(1), 1 << 18):
                raw = block.raw
                sums = blocks.prefix_sums(raw)
                # Code points begin at bytes that aren't continuations.
                begin = np.flatnonzero((raw & 0xC0) != 0x80)
                of = np.searchsorted(begin, block.bounds)
                word = np.repeat(np.arange(len(block)), np.diff(of))
                lo, hi = block.bounds[:-1][word], block.bounds[1:][word]
                after = np.append(begin[1:], len(raw))
                letter = blocks.span_hashes(sums, begin, after)
                first = np.ones(len(begin), bool)
                first[1:] = (letter[1:] != letter[:-1]) | (word[1:] != word[:-1])
                # Gaps stand before each code point and behind the last one.
                row = np.arange(len(block))
                gap_word = np.concatenate([word, row])
                gap = np.concatenate([begin, block.bounds[1:]])
                parts = (
                    (word, lo, begin, after, hi, np.zeros(len(begin), bool), first),
                    (gap_word, block.bounds[:-1][gap_word], gap, gap, block.bounds[1:][gap_word], np.ones(len(gap), bool), np.zeros(len(gap), bool)),
                )
                for own, left, end, start, right, is_open, is_first in parts:
                    prefix, suffix = blocks.span_hashes(sums, left, end), blocks.span_hashes(sums, start, right)
                    at = block.first + own
                    columns = (prefix.view(np.int64), suffix.view(np.int64), number[at], n[at], is_open, is_first)
                    table = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                    yield from (table.slice(k, 1 << 16) for k in range(0, len(table), 1 << 16))

    schema = "prefix long, suffix long, number long, n long, open boolean, first boolean"
    return words.select("number", "word", "n").mapInArrow(run, schema)


def neighbours(words: DataFrame) -> DataFrame:
    """Rows (number, word, n) to (number, n_near, best): the words at one edit, and (n, number) of the one with the largest n."""
    pairs = node_pairs(words)
    member = F.struct(F.col("number"), F.col("n"), F.col("open"), F.col("first"))
    groups = pairs.groupBy("prefix", "suffix").agg(F.collect_list(member).alias("members")).filter("size(members) > 1")
    # Partners: both skip here, or one skips at the first place of a run and the other is open.
    partner = "m.number <> number AND ((NOT m.open AND NOT open) OR (m.open AND first) OR (open AND m.first))"
    each = groups.select(F.explode("members").alias("own"), "members").select("own.*", "members")
    partners = each.withColumn("partners", F.expr(f"filter(members, m -> {partner})")).filter("size(partners) > 0")
    best = F.expr("array_min(transform(partners, m -> struct(-m.n AS less, m.number AS number)))")
    found = partners.select("number", F.size("partners").alias("k"), best.alias("best"))
    return found.groupBy("number").agg(F.sum("k").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """Rows (number, form) to (number, root): the last word on the way; a link's word never has links back to it."""
    now = links.select("number", F.col("form").alias("root"))
    while True:
        step = now.select(F.col("number").alias("root"), F.col("root").alias("further"))
        now = stored(now.join(step, "root", "left").select("number", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("number", "root")
        now = now.select("number", "root")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = DAMAGE,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = 2,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    counts = counted(picked(docs, id=id_col, text=text_col), every, least_letters).filter(F.col("n") >= least_count)
    # Numbers rise in the order of the words; they are fixed by being written.
    words = stored(counts.orderBy("word").withColumn("number", F.monotonically_increasing_id()), "words")
    near = stored(neighbours(words), "near")
    chosen = words.join(near, "number", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    chosen = chosen.select("number", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best.number")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    chosen = stored(chosen, "chosen")
    ends = roots(chosen.filter("form is not null").select("number", "form"))
    names = words.select(F.col("number").alias("of"), F.col("word").alias("name"))
    # Names of forms and roots: only linked words meet the table again.
    linked = ends.join(chosen.select("number", "form", "form_n"), "number")
    linked = linked.join(names, F.col("form") == F.col("of")).select("number", "root", F.col("name").alias("form_word"))
    linked = linked.join(names, F.col("root") == F.col("of")).select("number", "form_word", F.col("name").alias("root_word"))
    out = chosen.join(linked, "number", "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
