"""Phrases of two to five words that stand together more often than chance, by exact counts over the whole corpus.

A text is lower-cased (A-Z), cut into pieces at `. , ; : ! ?` and line ends, and these into words at spaces and tabs.
Everything is counted for each `lang` by itself; rows without one are `und`. A phrase of n words is counted as often as
it stands within pieces, overlaps included.

Blocks of texts (chunks) are written once as numbers: a chunk's own dictionary of words and its text as places in it.
Ranges of words are merged over all chunks; those of `LEAST` occurrences or more get ids, and every chunk is answered
which of its own words they are. No chunk needs more of the vocabulary, so nothing is broadcast. Then phrases are
counted level by level. A phrase can only be frequent if
what it is without its first or its last word is, so a chunk counts the n-grams made of two frequent ones that overlap.
An n-gram is one number: the id of its first n - 1 words and the id of its last. A chunk's numbers go into a counting
quotient filter, cut by their first bits; filters of the same range of all chunks are merged, frequent n-grams get ids,
and every chunk is answered which of its own are frequent. All counts are exact, and the filters lossless.

The score of a phrase of `a` occurrences, cut into two with `l` and `r`, is floor(1000 * a * n / (l * r)), where n is
the number of words of the language; the cut with the lowest score counts, and of equal ones the first. Phrases whose
words are part of a longer frequent one with as many occurrences are left out.

Null and empty texts have no words; rows without a doc_id count like others, repeated rows as often as they occur.
An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barsieve.llm.common import staged, text_blocks
from barsieve.llm.quotient_filter import merged, pack, permuted, unpack, unpermuted
from barsieve.llm.textblocks import U64, TextBlock, mix

#: Fewest occurrences of a phrase, most words, and phrases listed for each language.
LEAST, LONGEST, TOP = 100, 5, 2000
#: A phrase goes into a longer one that has at least this percentage of its occurrences.
CONTAINED = 100
#: Bytes of text in a chunk; a longer text makes a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Words or n-grams of all chunks that one task merges, about.
MERGED_KEYS = 1 << 21

_BLANK = [0x20, 0x09]
_BREAK = [*b".,;:!?", *range(0x0A, 0x0E)]


def _table(values: list[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[values] = True
    return table


def pieces_of_words(texts: TextBlock) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of a block, the row of each, and whether it is the first of its piece."""
    data, breaks = texts.data, _table(_BREAK)[texts.data]
    inside = ~(breaks | _table(_BLANK)[data])
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[texts.offsets] = True
    first = inside & np.concatenate([[True], ~inside[:-1]])[: len(data)] | (inside & begins[:-1])
    last = inside & (np.concatenate([~inside[1:], [True]])[: len(data)] | begins[1:])
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    held = np.ascontiguousarray(data[inside])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(held)]
    )
    row = np.searchsorted(texts.offsets, start, side="right") - 1
    passed = np.cumsum(breaks)[start] if len(start) else start
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (passed[1:] != passed[:-1])
    return words, row, fresh


def packed_numbers(values: np.ndarray) -> bytes:
    """Numbers from 0 in as many planes of bytes as the largest needs, compressed."""
    planes = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    columns = values.astype("<u8").view(np.uint8).reshape(len(values), 8)[:, :planes]
    return bytes([planes]) + zstandard.compress(np.ascontiguousarray(columns.T).tobytes(), 1)


def unpacked_numbers(packed: bytes) -> np.ndarray:
    planes = packed[0]
    columns = np.frombuffer(zstandard.decompress(packed[1:]), dtype=np.uint8).reshape(planes, -1)
    wide = np.zeros((columns.shape[1], 8), dtype=np.uint8)
    wide[:, :planes] = columns.T
    return wide.view("<u8").reshape(-1).astype(np.int64)


def _mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """Rows that a function makes, as Arrow batches, of each row given as a dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from function(batch.slice(k, 1).to_pylist()[0])

    return df.mapInArrow(run, schema)


def packed_table(table: pa.Table | pa.RecordBatch) -> bytes:
    """A table as compressed Arrow data."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def unpacked_table(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def chunks(docs: DataFrame) -> DataFrame:
    """Blocks of texts: `words` (a table of the distinct ones with their language and count) and `text`, places in it from 1.

    A zero stands between pieces. A chunk's number is that of its task and block; it is written with the chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, block in enumerate(text_blocks(batches, limit=CHUNK_BYTES)):
            words, row, fresh = pieces_of_words(TextBlock(block.column("text"), lower=True))
            if not len(words):
                continue
            known = words.dictionary_encode()
            langs = block.column("lang").dictionary_encode()
            own = langs.indices.to_numpy()[row].astype(np.int64) * len(known.dictionary) + known.indices.to_numpy()
            kinds, places, counts = np.unique(own, return_inverse=True, return_counts=True)
            lang, word = np.divmod(kinds, len(known.dictionary))
            text = np.zeros(len(words) + int(fresh.sum()), dtype=np.int64)
            text[np.arange(len(words)) + np.cumsum(fresh)] = places.reshape(-1) + 1
            columns = [langs.dictionary.take(lang).cast(pa.string()), known.dictionary.take(word).cast(pa.string())]
            listed = pa.table([*columns, pa.array(counts)], names=["lang", "word", "n"])
            yield pa.RecordBatch.from_pydict(
                {"chunk": [task + k], "kinds": [len(kinds)], "words": [packed_table(listed)], "text": [packed_numbers(text)]}
            )

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(run, "chunk long, kinds long, words binary, text binary")


def _text_hashes(values: pa.ChunkedArray) -> np.ndarray:
    block = TextBlock(values.combine_chunks())
    return block.hashes(block.offsets[:-1], block.offsets[1:])


def _word_tables(row: dict, part_bits: int) -> Iterator[pa.RecordBatch]:
    """A chunk's words with their counts and places, as one table for each range of their hashes."""
    listed = unpacked_table(row["words"])
    hashes = mix(_text_hashes(listed.column("word")) ^ mix(_text_hashes(listed.column("lang"))))
    parts = (hashes & U64((1 << part_bits) - 1)).astype(np.int64)
    order = np.argsort(parts, kind="stable")
    listed = listed.append_column("place", pa.array(np.arange(1, len(parts) + 1))).take(order)
    found, starts = np.unique(parts[order], return_index=True)
    for part, start, end in zip(found.tolist(), starts, np.append(starts[1:], len(parts)), strict=True):
        words = packed_table(listed.slice(start, end - start).combine_chunks())
        yield pa.RecordBatch.from_pydict({"part": [part], "chunk": [row["chunk"]], "words": [words]})


def _merged_words(rows: pa.Table, least: int, part_bits: int) -> pa.Table:
    """The words of one range: frequent ones with ids, and their total in each language, in a row without chunk.

    For each chunk, the places of its frequent words and their ids.
    """
    part = rows.column("part")[0].as_py()
    tables = [unpacked_table(w) for w in rows.column("words").to_pylist()]
    every = pa.concat_tables(tables)
    langs = every.column("lang").combine_chunks().dictionary_encode()
    words = every.column("word").combine_chunks().dictionary_encode()
    own = langs.indices.to_numpy().astype(np.int64) * len(words.dictionary) + words.indices.to_numpy()
    kinds, of = np.unique(own, return_inverse=True)
    of = of.reshape(-1)
    counts = np.zeros(len(kinds), dtype=np.int64)
    np.add.at(counts, of, every.column("n").to_numpy())
    frequent = counts >= least
    ids = np.zeros(len(kinds), dtype=np.int64)
    ids[frequent] = np.arange(int(frequent.sum())) * (1 << part_bits) + part + 1
    lang, word = np.divmod(kinds, len(words.dictionary))
    totals = np.zeros(len(langs.dictionary), dtype=np.int64)
    np.add.at(totals, lang, counts)
    named = [langs.dictionary.take(lang[frequent]), words.dictionary.take(word[frequent])]
    listed = pa.table([*named, pa.array(counts[frequent]), pa.array(ids[frequent])], names=["lang", "word", "a", "id"])
    whole = pa.table([langs.dictionary, pa.array(totals)], names=["lang", "n"])
    out = {"chunk": [None], "keys": [packed_table(listed)], "ids": [packed_table(whole)]}
    cuts = np.cumsum([t.num_rows for t in tables])[:-1]
    places = np.split(every.column("place").to_numpy(), cuts)
    for chunk, place, found in zip(rows.column("chunk").to_pylist(), places, np.split(ids[of], cuts), strict=True):
        if found.any():
            out["chunk"].append(chunk)
            out["keys"].append(packed_numbers(place[found > 0]))
            out["ids"].append(packed_numbers(found[found > 0]))
    return pa.table([pa.array(v, t) for v, t in zip(out.values(), _ANSWER, strict=True)], names=list(out))


_ANSWER = [pa.int64(), pa.binary(), pa.binary()]


def _ranges(keys: int) -> int:
    """Bits for the number of ranges in which so many keys are merged."""
    return max(0, math.ceil(keys / MERGED_KEYS) - 1).bit_length()


def _to_chunks(held: DataFrame, answers: DataFrame, rewrite) -> DataFrame:
    """The chunks that have frequent phrases, rewritten by what was answered to them."""
    own = answers.where("chunk is not null").groupBy("chunk")
    own = own.agg(F.collect_list(F.struct("keys", "ids")).alias("answers"))
    return _mapped(held.join(own, "chunk"), rewrite, _CHUNK)


def _rewritten(text: np.ndarray, keep: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The columns at the places to keep, with one zero wherever some are left out between two."""
    at = np.flatnonzero(keep)
    gap = np.ones(len(at), dtype=np.int64)
    gap[1:] = at[1:] != at[:-1] + 1
    to = np.arange(len(at)) + np.cumsum(gap)
    out = []
    for values in columns:
        made = np.zeros(len(at) + int(gap.sum()) + 1, dtype=np.int64)
        made[to] = values[at]
        out.append(made)
    return out


def _with_ids(row: dict) -> Iterator[pa.RecordBatch]:
    """A chunk with its frequent words as ids, which are its phrases of one word as well."""
    text = unpacked_numbers(row["text"])
    ids = np.zeros(int(text.max(initial=0)) + 1, dtype=np.int64)
    for found in row["answers"]:
        ids[unpacked_numbers(found["keys"])] = unpacked_numbers(found["ids"])
    text = ids[text]
    (words,) = _rewritten(text, text > 0, text)
    yield pa.RecordBatch.from_pydict(
        {"chunk": [row["chunk"]], "words": [packed_numbers(words)], "phrases": pa.array([None], pa.binary())}
    )


def _candidates(row: dict, n: int, word_bits: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's words, and the places and permuted keys of its n-grams made of two known ones of n - 1 words."""
    words = unpacked_numbers(row["words"])
    phrases = words if row["phrases"] is None else unpacked_numbers(row["phrases"])
    at = np.flatnonzero((phrases[:-1] > 0) & (phrases[1:] > 0))
    keys = (phrases[at] << word_bits) | words[at + n - 1]
    return words, at, permuted(keys, bits)


def _filters(row: dict, n: int, word_bits: int, bits: int, part_bits: int) -> Iterator[pa.RecordBatch]:
    """A chunk's n-grams with their counts, as one filter for each range of permuted keys."""
    _, _, found = _candidates(row, n, word_bits, bits)
    keys, counts = np.unique(found, return_counts=True)
    rest = bits - part_bits
    parts, starts = np.unique(keys >> U64(rest), return_index=True)
    ends = np.append(starts[1:], len(keys))
    low = keys & U64((1 << rest) - 1)
    if len(parts):
        yield pa.RecordBatch.from_pydict(
            {
                "part": parts.astype(np.int64),
                "chunk": np.full(len(parts), row["chunk"], dtype=np.int64),
                "filter": [pack(low[a:b], counts[a:b], rest) for a, b in zip(starts, ends, strict=True)],
            }
        )


def _merged(rows: pa.Table, least: int, bits: int, part_bits: int) -> pa.Table:
    """The frequent n-grams of one range, in a row without chunk, and for each chunk those among its own."""
    part = rows.column("part")[0].as_py()
    filters = [unpack(f) for f in rows.column("filter").to_pylist()]
    keys, counts, places = merged(filters)
    keys |= U64(part << (bits - part_bits))
    frequent = counts >= least
    ids = np.zeros(len(keys), dtype=np.int64)
    ids[frequent] = np.arange(int(frequent.sum())) * (1 << part_bits) + part + 1
    plain = unpermuted(keys[frequent], bits).astype(np.int64)
    listed = pa.table([plain, ids[frequent], counts[frequent].astype(np.int64)], names=["key", "id", "a"])
    out = {"chunk": [None], "keys": [packed_table(listed)], "ids": [b""]}
    for chunk, place in zip(rows.column("chunk").to_pylist(), places, strict=True):
        place = place[frequent[place]]
        if len(place):
            out["chunk"].append(chunk)
            out["keys"].append(packed_numbers(np.diff(keys[place], prepend=U64(0))))
            out["ids"].append(packed_numbers(ids[place]))
    return pa.table([pa.array(v, t) for v, t in zip(out.values(), _ANSWER, strict=True)], names=list(out))


def _answered(row: dict, n: int, word_bits: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A chunk with the ids of its frequent n-grams; places that are part of none are left out."""
    words, at, found = _candidates(row, n, word_bits, bits)
    keys = np.concatenate([np.cumsum(unpacked_numbers(a["keys"])).astype(U64) for a in row["answers"]])
    ids = np.concatenate([unpacked_numbers(a["ids"]) for a in row["answers"]])
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    phrases = np.zeros(len(words), dtype=np.int64)
    phrases[at] = np.where(keys[place] == found, ids[place], 0)
    part_of = np.zeros(len(words) + n, dtype=bool)
    for k in range(n):
        part_of[k : k + len(words)] |= phrases > 0
    words, phrases = _rewritten(words, part_of[: len(words)], words, phrases)
    yield pa.RecordBatch.from_pydict(
        {"chunk": [row["chunk"]], "words": [packed_numbers(words)], "phrases": [packed_numbers(phrases)]}
    )


def _listed(answers: DataFrame, column: str, schema: str) -> DataFrame:
    """The rows of the tables that stand in the rows without chunk."""
    return _mapped(
        answers.where("chunk is null").select(column), lambda r: unpacked_table(r[column]).to_batches(), schema
    )


_CHUNK = "chunk long, words binary, phrases binary"
_ANSWERS = "chunk long, keys binary, ids binary"


def _level(held: DataFrame, n: int, least: int, word_bits: int, most: int, keys: int) -> tuple[DataFrame, DataFrame]:
    """Frequent n-grams (`id`, `prefix`, `last`, `a`) and the chunks with their ids, from chunks with those of n - 1.

    `most` is the largest id of an (n-1)-gram, `keys` a bound of the n-grams to merge.
    """
    bits = max(16, word_bits + int(most).bit_length())
    if bits > 63:
        raise ValueError(f"{bits} bits for a phrase of {n} words")
    part_bits = min(bits, _ranges(keys))
    sent = _mapped(held, lambda r: _filters(r, n, word_bits, bits, part_bits), "part long, chunk long, filter binary")
    answers = sent.groupBy("part").applyInArrow(lambda t: _merged(t, least, bits, part_bits), _ANSWERS)
    answers = staged(answers, f"answers-{n}")
    phrases = _listed(answers, "keys", "key long, id long, a long").select(
        "id", F.shiftright("key", word_bits).alias("prefix"), F.col("key").bitwiseAND((1 << word_bits) - 1).alias("last"), "a"
    )
    held = _to_chunks(held, answers, lambda r: _answered(r, n, word_bits, bits))
    return staged(phrases, f"frequent-{n}"), staged(held, f"chunks-{n}")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """The frequent phrases of 1 to `longest` words of `docs` (lang, text), and the words of each language.

    `lang`, `phrase`, `ids` (of its words), `a`; and `lang`, `n`.
    """
    held = staged(chunks(docs), "chunks")
    # one number, from which the number of ranges follows
    part_bits = _ranges(held.agg(F.sum("kinds")).first()[0] or 0)
    sent = _mapped(held.select("chunk", "words"), lambda r: _word_tables(r, part_bits), "part long, chunk long, words binary")
    answers = staged(sent.groupBy("part").applyInArrow(lambda t: _merged_words(t, least, part_bits), _ANSWERS), "answers-1")
    totals = _listed(answers, "ids", "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    totals = staged(totals, "languages")
    vocabulary = staged(_listed(answers, "keys", "lang string, word string, a long, id long"), "vocabulary")
    held = staged(_to_chunks(held.select("chunk", "text"), answers, _with_ids), "chunks-1")
    # two numbers, from which the widths of keys and the number of ranges follow
    most = vocabulary.agg(F.max("id")).first()[0] or 1
    keys = totals.agg(F.sum("n")).first()[0] or 0
    word_bits = int(most).bit_length()
    shorter = vocabulary.select("id", "lang", F.col("word").alias("phrase"), F.array("id").alias("ids"), "a")
    every = shorter
    last = vocabulary.select(F.col("id").alias("last"), "word")
    for n in range(2, longest + 1):
        phrases, held = _level(held, n, least, word_bits, most, keys)
        prefix = shorter.select(F.col("id").alias("prefix"), "lang", "phrase", "ids")
        longer = phrases.join(prefix, "prefix").join(last, "last")
        text, ids = F.concat_ws(" ", "phrase", "word"), F.concat("ids", F.array("last"))
        shorter = staged(longer.select("id", "lang", text.alias("phrase"), ids.alias("ids"), "a"), f"texts-{n}")
        every = every.unionAll(shorter)
        most = phrases.agg(F.max("id")).first()[0] or 1
        # an n-gram holds a frequent one, so no more can be left than these have occurrences
        keys = phrases.agg(F.sum("a")).first()[0] or 0
    return every.drop("id"), totals


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, contained: int = CONTAINED
) -> DataFrame:
    """The best phrases of each language: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    By score, then occurrences, both falling, then phrase in the order of its bytes.
    """
    every, totals = frequent_phrases(docs, least, longest)
    several = every.where(F.size("ids") > 1)
    longer = every.where(F.size("ids") > 2).select("ids", F.col("a").alias("above"))
    lengths = F.sequence(F.lit(2), F.size("ids") - 1)
    inner = lambda m: F.transform(F.sequence(F.lit(1), F.size("ids") - m + 1), lambda s: F.slice("ids", s, m))
    parts = longer.select(F.explode(F.flatten(F.transform(lengths, inner))).alias("ids"), "above")
    parts = parts.groupBy("ids").agg(F.max("above").alias("above"))
    alone = several.join(parts, "ids", "left").where(
        F.col("above").isNull() | (100 * _exact("above") < contained * _exact("a"))
    )
    alone = alone.select("lang", "phrase", "ids", "a").join(totals, "lang")
    cuts = alone.select("*", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    counts = every.select("ids", "a")
    left, right = F.slice("ids", F.lit(1), F.col("k")), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))
    cuts = cuts.withColumns({"left": left, "right": right}).drop("ids")
    cuts = cuts.join(counts.toDF("left", "l"), "left").join(counts.toDF("right", "r"), "right")
    wide = cuts.withColumns({"_a": _exact("a"), "_n": _exact("n"), "_l": _exact("l"), "_r": _exact("r")})
    scored = wide.withColumn("score", F.expr("(_a * _n * cast(1000 as decimal(4,0))) div (_l * _r)"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
