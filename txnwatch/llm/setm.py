"""Phrases whose words stand together more often than chance, mined by set-oriented relations (SETM).

Texts become sorted occurrence relations that are written out. Relation k holds, per
piece and position, the group (phrase of k words) that starts there. It is merge-joined
with relation 1 by piece and adjacent position, the phrases of k + 1 words that come of
it are grouped and counted, and a semi-join with the groups that are frequent leaves
relation k + 1, before phrases are made longer.

A row of a stored relation is a stretch of ``STRETCH`` positions in order, with the few
words that follow it, so a merge-join is one pass over two sorted runs and moves
nothing. The end of a piece takes a position of its own that no phrase crosses; texts
of any length are many rows. Only groups with their counts are shuffled, counted per
task before that, and in ranges: a row holds all groups of a task that lie in one
range of numbers, so what is sorted and added up is arrays. Frequent groups have dense
numbers, so a longer phrase is one number made of its first part's and its last word's.

A table of frequent groups of at most ``SMALL`` rows and ``SMALL_BYTES`` is sent to the
tasks for the semi-join. A larger one is joined with the distinct groups of each block
of ``BLOCK`` stretches, and what is frequent meets its block again: at most as many rows
of a group meet in one task as there are blocks, and a block is bounded.

Cases: null text is empty, a null language is ``und``; ids are not read, so repeated and
null ones count as any row; a language without a frequent phrase has no rows, as has an
empty table. Only ``lang`` and ``text`` are read.
"""

import string
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from txnwatch.llm.common import few_rows_at_a_time, slices_by_size
from txnwatch.session import materialize

#: Positions in a row of a relation, and rows in a block.
STRETCH, BLOCK = 512, 1024
#: Parquet codec of the relations, which are the larger part of what is stored.
CODEC = "zstd"
#: Bytes of texts that are cut into words at a time.
TEXTS = 1 << 21
#: Positions whose phrases are counted before they are sent, bytes of words likewise, and groups that are added up in a range, about.
COUNTED, COUNTED_BYTES, RANGE = 1 << 22, 1 << 25, 1 << 21
#: The largest table of frequent groups that is sent to the tasks, in rows and bytes of words.
SMALL, SMALL_BYTES = 1 << 22, 1 << 25
#: Parts in which a language's phrases are ranked before the best of each are ranked together.
RANKED = 32
#: Stands where a piece ends. It separates pieces, so it is no word.
END = "."
#: Capitals become small, tabs blanks, and what ends a piece ``END``.
_BYTES = bytes.maketrans(f"{string.ascii_uppercase}\t,;:!?\n\v\f\r".encode(), f"{string.ascii_lowercase} {END * 9}".encode())

RELATION = "block long, own int, words binary, groups binary"


def words_in_pieces(texts: pa.Array) -> list[bytes]:
    """Words of all texts in order, ``END`` after each piece."""
    end = END.encode()
    pieces = b"".join(text + end for text in pc.cast(pc.fill_null(texts, ""), pa.large_binary()).to_pylist()).translate(_BYTES)
    # blanks are all the white space that is left
    return pieces.replace(end, b" %s " % end).split()


def stretches(docs: DataFrame, longest: int) -> DataFrame:
    """Relation 1 before words are counted: block, lang, own (positions that start phrases) and words, separated by blanks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        block = (task + number // BLOCK for number in count())
        for batch in slices_by_size(batches, size=TEXTS):
            rows = []
            for lang in pc.unique(batch.column(0)):
                words = words_in_pieces(batch.filter(pc.equal(batch.column(0), lang)).column(1))
                for start in range(0, len(words), STRETCH):
                    own = min(STRETCH, len(words) - start)
                    rows.append((next(block), lang.as_py(), own, b" ".join(words[start: start + own + longest - 1])))
            yield pa.RecordBatch.from_pylist([dict(zip(("block", "lang", "own", "words"), row)) for row in rows], _STRETCHES)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return few_rows_at_a_time(rows).mapInArrow(run, "block long, lang string, own int, words string")


_STRETCHES = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("own", pa.int32()), ("words", pa.string())])


def _per_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, pa.DictionaryArray, np.ndarray, np.ndarray]]:
    """Per language of some stretches: it, which rows, their words, where each row's words begin and end, and which start phrases."""
    langs = batch.column("lang")
    for lang in pc.unique(langs):
        rows = np.flatnonzero(np.asarray(pc.equal(langs, lang)))
        some = batch.take(pa.array(rows))
        cut = pc.split_pattern(pc.cast(some.column("words"), pa.large_string()), " ")
        first = np.asarray(cut.offsets, np.int64)
        place = np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))
        mine = place < np.repeat(np.asarray(some.column("own"), np.int64), np.diff(first))
        yield lang.as_py(), rows, pc.dictionary_encode(cut.flatten()), first, mine


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, n: counted per some ``COUNTED_BYTES``, to be summed."""

    def total(held: list[pa.Table]) -> list[pa.RecordBatch]:
        found = pa.concat_tables(held).group_by(["lang", "word"], use_threads=False).aggregate([("n", "sum")])
        return pa.table({"lang": found["lang"], "word": found["word"], "n": found["n_sum"]}).to_batches(1 << 16)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for lang, _, words, _, mine in _per_lang(batch):
                n = np.bincount(np.asarray(words.indices, np.int64)[mine], minlength=len(words.dictionary))
                seen = pa.array((n > 0) & np.asarray(pc.not_equal(words.dictionary, END)))
                known = words.dictionary.filter(seen).cast(pa.string())
                held.append(pa.table({"lang": pa.repeat(pa.scalar(lang, pa.string()), len(known)), "word": known, "n": pa.array(n).filter(seen)}))
            if sum(table.nbytes for table in held) > COUNTED_BYTES:
                yield from total(held)
                held = []
        if held:
            yield from total(held)

    return few_rows_at_a_time(texts).mapInArrow(run, "lang string, word string, n long")


def numbered(groups: DataFrame) -> DataFrame:
    """``groups`` with ``id``, 0, 1, 2 and so on in no particular order: places in the stored parts, carried over from part to part."""
    stored = materialize(groups.withColumn("_row", F.monotonically_increasing_id()), "frequent-groups")
    part = F.shiftright("_row", 33)
    # one row per part of the table, whatever its size
    before = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rows = stored.join(F.broadcast(before), part == F.col("_part"))
    return rows.withColumn("id", F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))).drop("_row", "_part", "_n", "_before")


def _packed(values: np.ndarray, first: np.ndarray, kind: str) -> pa.Array:
    """A binary array that holds ``values`` from one of ``first`` to the next."""
    values = np.ascontiguousarray(values, kind)
    offsets = (first * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _kind(n: int) -> str:
    return "<i4" if n < 1 << 31 else "<i8"


def _numbered_words(batch: pa.RecordBatch, ids_of: Callable[[str, pa.Array], np.ndarray], kind: str) -> Iterator[pa.RecordBatch]:
    """Relation 1: words as numbers, -1 where a piece ends or a word isn't frequent."""
    for lang, rows, words, first, _ in _per_lang(batch):
        ids = ids_of(lang, words.dictionary)[np.asarray(words.indices, np.int64)] if len(words) else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("block").take(pa.array(rows)), batch.column("own").take(pa.array(rows)), _packed(ids, first, kind), pa.nulls(len(rows), pa.binary())],
            ["block", "own", "words", "groups"])


def _joined(batch: pa.RecordBatch, length: int, n_words: int, kinds: tuple[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The merge-join: numbers of phrases of ``length`` words with the positions where they start, all words, where rows begin, and starts of rows among the groups."""
    words = np.frombuffer(b"".join(batch.column("words").to_pylist()), kinds[0]).astype(np.int64)
    own = np.asarray(batch.column("own"), np.int64)
    first = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(batch.column("words")), np.int64) // np.dtype(kinds[0]).itemsize)])
    starts = np.concatenate([[0], np.cumsum(own)])
    # place among all words of each position that starts phrases
    place = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], own)
    groups = words[place] if length == 2 else np.frombuffer(b"".join(batch.column("groups").to_pylist()), kinds[1]).astype(np.int64)
    ends = np.repeat(first[1:], own)
    live = np.flatnonzero((groups >= 0) & (place + length - 1 < ends))
    live = live[words[place[live] + length - 1] >= 0]
    return groups[live] * n_words + words[place[live] + length - 1], live, words, first, starts


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys``, ascending, and the sum of each one's ``n``."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


def phrase_counts(relation: DataFrame, length: int, n_left: int, n_words: int, kinds: tuple[str, str], min_count: int, ranges: int) -> DataFrame:
    """key, a of phrases of ``length`` words that occur ``min_count`` times, of ``n_left`` first parts; counted in ``ranges`` of keys, a row a task and range."""
    width = -(-n_left * n_words // ranges)
    kind = _kind(width)

    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        part = keys // width
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])[:len(part)])
        cuts = np.append(first, len(keys))
        return pa.RecordBatch.from_arrays([pa.array(part[first]), _packed(keys - part * width, cuts, kind), _packed(n, cuts, "<i4")], ["part", "keys", "n"])

    def count_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held.append(_joined(batch, length, n_words, kinds)[0])
            if sum(map(len, held)) >= COUNTED:
                yield rows(held)
                held = []
        if held:
            yield rows(held)

    def often(part: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, a = _added(*map(np.concatenate, zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(keys[a >= min_count] + part * width), pa.array(a[a >= min_count])], ["key", "a"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for batch in batches:
            for part, keys, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if held and part != now:
                    yield often(now, held)
                    held, size = [], 0
                now = part
                held.append((np.frombuffer(keys.as_buffer(), kind).astype(np.int64), np.frombuffer(n.as_buffer(), "<i4").astype(np.int64)))
                size += len(held[-1][0])
                if size > 2 * RANGE and size > 2 * len(held[0][0]):
                    held = [_added(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
        if held:
            yield often(now, held)

    sent = few_rows_at_a_time(relation).mapInArrow(count_, "part long, keys binary, n binary")
    return sent.repartition(ranges, "part").sortWithinPartitions("part").mapInArrow(add, "key long, a long")


def phrase_blocks(relation: DataFrame, length: int, n_words: int, kinds: tuple[str, str]) -> DataFrame:
    """key, block of phrases of ``length`` words, distinct per few stretches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [len(list(rows)) for _, rows in groupby(batch.column("block").to_pylist())]
            for start, rows in zip(np.cumsum([0, *cuts]).tolist(), cuts):
                keys = np.unique(_joined(batch.slice(start, rows), length, n_words, kinds)[0])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), batch.column("block")[start].as_py()))], ["key", "block"])

    return few_rows_at_a_time(relation).mapInArrow(run, "key long, block long")


def _longer(batch: pa.RecordBatch, length: int, longest: int, n_words: int, kinds: tuple[str, str], keys: np.ndarray, ids: np.ndarray, kind: str) -> pa.RecordBatch:
    """The semi-join: the relation of phrases of ``length`` words, of which ``keys`` (ascending) are frequent."""
    found, live, words, first, starts = _joined(batch, length, n_words, kinds)
    at = np.minimum(np.searchsorted(keys, found), max(0, len(keys) - 1))
    hit = keys[at] == found if len(keys) else np.zeros(len(found), bool)
    groups = np.full(starts[-1], -1, np.int64)
    groups[live[hit]] = ids[at[hit]]
    # words that no phrase can grow into are forgotten
    places = live[hit] + np.repeat(first[:-1] - starts[:-1], np.diff(starts))[live[hit]]
    wanted = np.zeros(len(words) + longest, bool)
    for step in range(length, longest):
        wanted[places + step] = True
    words = np.where(wanted[:len(words)], words, -1)
    alive = pa.array(np.add.reduceat(groups >= 0, starts[:-1]) > 0 if batch.num_rows else [], pa.bool_())
    columns = [batch.column("block"), batch.column("own"), _packed(words, first, kinds[0]), _packed(groups, starts, kind)]
    return pa.RecordBatch.from_arrays(columns, ["block", "own", "words", "groups"]).filter(alive)


def _first_relation(texts: DataFrame, frequent: DataFrame, kind: str, small: int) -> DataFrame:
    size = frequent.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    if size[0] <= small and size[1] <= SMALL_BYTES:
        table = frequent.select("lang", "word", "id").toArrow()
        sent = texts.sparkSession.sparkContext.broadcast({lang.as_py(): (
            pa.array((own := table.filter(pc.equal(table["lang"], lang)))["word"].to_pylist(), pa.large_string()), np.append(own["id"].to_numpy(), -1)) for lang in pc.unique(table["lang"])})

        def ids_of(lang: str, words: pa.Array) -> np.ndarray:
            known, ids = sent.value.get(lang, (pa.array([], pa.large_string()), np.array([-1])))
            return ids[np.asarray(pc.fill_null(pc.index_in(words, known), -1))]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _numbered_words(batch, ids_of, kind)

        return few_rows_at_a_time(texts).mapInArrow(run, RELATION)

    distinct = texts.select("block", "lang", F.explode(F.array_distinct(F.split("words", " "))).alias("word")).distinct()
    known = distinct.join(frequent.select("lang", "word", "id"), ["lang", "word"])
    known = known.select(F.col("block").alias("_block"), F.col("lang").alias("_lang"), F.col("word").alias("_word"), F.col("id").alias("_id"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        held = {(lang, word): i for lang, word, i in zip(*(right[name].to_pylist() for name in ("_lang", "_word", "_id")))}
        ids_of = lambda lang, words: np.array([held.get((lang, word), -1) for word in words.to_pylist()], np.int64)
        parts = [part for batch in left.to_batches() for part in _numbered_words(batch, ids_of, kind)]
        return pa.Table.from_batches(parts, _RELATION)

    return texts.groupBy("block").cogroup(known.groupBy("_block")).applyInArrow(meet, RELATION)


_RELATION = pa.schema([("block", pa.int64()), ("own", pa.int32()), ("words", pa.binary()), ("groups", pa.binary())])


def _next_relation(relation: DataFrame, frequent: DataFrame, n_frequent: int, length: int, longest: int, n_words: int, kinds: tuple[str, str], small: int) -> DataFrame:
    kind = _kind(n_frequent)
    if n_frequent <= small:
        table = frequent.select("key", "id").toArrow()
        order = np.argsort(table["key"].to_numpy())
        sent = relation.sparkSession.sparkContext.broadcast((table["key"].to_numpy()[order], table["id"].to_numpy()[order].astype(kind)))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _longer(batch, length, longest, n_words, kinds, *sent.value, kind)

        return few_rows_at_a_time(relation).mapInArrow(run, RELATION)

    known = phrase_blocks(relation, length, n_words, kinds).distinct().join(frequent.select("key", "id"), "key")
    known = known.select(F.col("block").alias("_block"), F.col("key").alias("_key"), F.col("id").alias("_id"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, ids = right["_key"].to_numpy(), right["_id"].to_numpy()
        order = np.argsort(keys)
        return pa.Table.from_batches([_longer(batch, length, longest, n_words, kinds, keys[order], ids[order], kind) for batch in left.to_batches()], _RELATION)

    return relation.groupBy("block").cogroup(known.groupBy("_block")).applyInArrow(meet, RELATION)


def frequent_phrases(docs: DataFrame, min_count: int = 100, longest: int = 5, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` words that occur ``min_count`` times in a language (lang, words, a), and words in all per language (lang, n)."""
    texts = materialize(stretches(docs, longest), "stretches", CODEC)
    counts = word_counts(texts).groupBy("lang", "word").agg(F.sum("n").alias("a"))
    # words that are not frequent only count towards their language's total, so they are stored as one row
    kept = F.when(F.col("a") >= min_count, F.col("word")).alias("word")
    counts = materialize(counts.groupBy("lang", kept).agg(F.sum("a").alias("a")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = numbered(counts.filter(F.col("word").isNotNull()))
    words = frequent.select("id", "lang", "a", F.array("word").alias("words"))
    n_words = n_frequent = max(1, frequent.count())
    ranges = max(1, (totals.agg(F.sum("n")).first()[0] or 0) // RANGE)
    kinds = _kind(n_words), _kind(n_words)
    relation = materialize(_first_relation(texts, frequent, kinds[0], small), "relation-1", CODEC)
    levels = [words]
    for length in range(2, longest + 1):
        frequent = numbered(phrase_counts(relation, length, n_frequent, n_words, kinds, min_count, ranges))
        n_frequent = frequent.count()
        if not n_frequent:
            break
        parts = frequent.select("id", "a", F.expr(f"key div {n_words}L").alias("_left"), F.expr(f"key % {n_words}L").alias("_right"))
        left = levels[-1].select(F.col("id").alias("_left"), "lang", F.col("words").alias("_first"))
        right = words.select(F.col("id").alias("_right"), F.col("words").alias("_last"))
        level = parts.join(left, "_left").join(right, "_right").select("id", "lang", "a", F.concat("_first", "_last").alias("words"))
        levels.append(materialize(level, "phrases"))
        if length < longest:
            relation = materialize(_next_relation(relation, frequent, n_frequent, length, longest, n_words, kinds, small), f"relation-{length}", CODEC)
            kinds = kinds[0], _kind(n_frequent)
    return reduce(DataFrame.unionAll, [level.select("lang", "words", "a") for level in levels]), totals


def collocations(docs: DataFrame, min_count: int = 100, longest: int = 5, first: int = 2000, small: int = SMALL) -> DataFrame:
    """Each language's ``first`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    A phrase of two words or more scores by its weakest cut: how often it occurs, against what its two parts would
    give by chance (in thousandths). Phrases that always stand inside one longer phrase are left to that.
    """
    groups, totals = frequent_phrases(docs, min_count, longest, small)
    groups = materialize(groups.withColumn("phrase", F.array_join("words", " ")), "frequent-phrases")
    size = F.size("words")
    phrases = groups.filter(size >= 2)
    part = lambda name, alias: groups.select("lang", F.col("phrase").alias(name), F.col("a").alias(alias))

    spans = F.expr(f"""flatten(transform(sequence(2, size(words) - 1), m ->
        transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))""")
    inside = groups.filter(size >= 3).select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    phrases = phrases.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("a")))

    cuts = phrases.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("_left", F.array_join(F.slice("words", F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("_right", F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " "))
    cuts = cuts.join(part("_left", "l"), ["lang", "_left"]).join(part("_right", "r"), ["lang", "_right"]).join(F.broadcast(totals) if _few(totals) else totals, "lang")
    # products pass 64 bits
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))")
    weakest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    rows = weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    # no phrase is among a language's first that isn't among the first of its part
    order, some = [F.desc("score"), F.desc("a"), "phrase"], F.pmod(F.xxhash64("phrase"), F.lit(RANKED))
    rows = rows.withColumn("_part", some)
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_place") <= first)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: Most languages whose totals are broadcast.
LANGUAGES = 10_000


def _few(totals: DataFrame) -> bool:
    return totals.limit(LANGUAGES + 1).count() <= LANGUAGES


ORACLE_SQL = f"""
WITH pieces AS (
  SELECT doc_id, lang, i, pieces[i] AS piece FROM (
    SELECT row_number() OVER () AS doc_id, coalesce(lang, 'und') AS lang,
           regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[.,;:!?\\x0A-\\x0D]') AS pieces
    FROM documents), unnest(range(1, len(pieces) + 1)) AS t(i)
), words AS (
  SELECT doc_id, i, lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda w: w <> '') AS ws FROM pieces
), spots AS (
  SELECT lang, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5
  FROM (SELECT doc_id, i, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS s FROM words)
  WINDOW p AS (PARTITION BY doc_id, i ORDER BY s)
), totals AS (SELECT lang, count(*) AS n FROM spots GROUP BY lang
), counted AS (
  SELECT lang, w AS phrase, count(*) AS a FROM spots GROUP BY ALL HAVING a >= 100 UNION ALL
  SELECT lang, w || ' ' || w2, count(*) AS a FROM spots WHERE w2 IS NOT NULL GROUP BY ALL HAVING a >= 100 UNION ALL
  SELECT lang, concat_ws(' ', w, w2, w3), count(*) AS a FROM spots WHERE w3 IS NOT NULL GROUP BY ALL HAVING a >= 100 UNION ALL
  SELECT lang, concat_ws(' ', w, w2, w3, w4), count(*) AS a FROM spots WHERE w4 IS NOT NULL GROUP BY ALL HAVING a >= 100 UNION ALL
  SELECT lang, concat_ws(' ', w, w2, w3, w4, w5), count(*) AS a FROM spots WHERE w5 IS NOT NULL GROUP BY ALL HAVING a >= 100
), groups AS (SELECT lang, string_split(phrase, ' ') AS phrase, a FROM counted
), inside AS (
  SELECT lang, phrase[s: s + m - 1] AS phrase, max(a) AS longer
  FROM groups, unnest(range(2, len(phrase))) AS t(m), unnest(range(1, len(phrase) - m + 2)) AS u(s) GROUP BY ALL
), cuts AS (
  SELECT g.lang, g.phrase, g.a, k, l.a AS l, r.a AS r, n, (1000 * g.a::HUGEINT * n) // (l.a::HUGEINT * r.a) AS score
  FROM groups g JOIN unnest(range(1, 5)) AS t(k) ON k < len(g.phrase)
  JOIN groups l ON l.lang = g.lang AND l.phrase = g.phrase[1: k]
  JOIN groups r ON r.lang = g.lang AND r.phrase = g.phrase[k + 1: len(g.phrase)]
  JOIN totals ON totals.lang = g.lang
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT w.lang, array_to_string(w.phrase, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM weakest w LEFT JOIN inside ON inside.lang = w.lang AND inside.phrase = w.phrase WHERE longer IS NULL OR longer < a
)
SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked
QUALIFY rank <= 2000
"""
