"""Ranked lexical search over posting lists that are cut into geometric blocks.

Documents become vectors over the terms of the questions.  The posting list of a term is
clustered by the similarity of its documents, and each block of similar documents keeps
the maximum of every coordinate.  A question's dot product with that summary bounds the
score of every document of the block, so a block is opened only if the bound reaches the
score that the question's k-th best document has already.  Bounds and scores are whole
numbers and the bounds are true ones: the answer is exact.

1. One pass over the texts keeps, per document, its length and the terms asked for.
2. Counts of documents, lengths and terms are added up; weights follow from them.
3. An opening pass scores a few promising documents per question and finds the largest
   impact of each term.  Documents that hold only terms which together stay below the
   opening score can't be among the best; the other lists are the ones that a question walks.
4. Documents are laid out by range of their rarest terms; stretches of neighbours build
   the blocks of every list walked, which are stored with their summaries next to the
   documents of the stretch.
5. Blocks are searched wherever they lie; the best of all tasks are merged.

A list is spread over as many tasks as its documents, so that a word that all documents
share is no task's burden.  Questions are taken in blocks of ``ITEMS`` with all documents
each; what the tasks are sent depends on one block of questions alone.

Defined results: a null or empty text or question has no terms; very long texts are read
whole, a task holding one at a time; equal scores go by ascending ``doc_id``, nulls last;
rows with an equal id are documents of their own, and so are questions; no documents or
no questions give no rows; columns other than the id and the text are left out,
whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.inputs import partitions
from tidemark.operators.joins import union_all
from tidemark.session import staged

TOP = 20
ITEMS = 2_000
OPENING_TERMS = 10
BLOCK = 16
SEGMENT = 2_048  # neighbouring documents whose lists are clustered together
MATRIX_CELLS = 1 << 22  # documents by terms of a stretch that a task holds at a time
NO_ID = (1 << 63) - 1

# digits, letters and every byte of a character beyond ASCII; only A-Z become lower case
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@dataclass
class Questions:
    """A block of questions over a numbered vocabulary."""

    ids: list
    terms: list[np.ndarray]  # distinct terms of each
    times: list[np.ndarray]  # how often each occurs
    vocabulary: dict[bytes, int]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    floors: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def weighed(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a question that can score, and what their impacts are multiplied by."""
        factor = self.times[j] * self.weights[self.terms[j]]
        return self.terms[j][factor > 0], factor[factor > 0]


def questions(rows: list[tuple]) -> Questions:
    vocabulary: dict[bytes, int] = {}
    ids, terms, times = [], [], []
    for item, text in rows:
        counted = Counter(terms_of(text.encode() if text else None))
        ids.append(item)
        terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in counted], np.int64))
        times.append(np.array(list(counted.values()), np.int64))
    return Questions(ids, terms, times, vocabulary)


def _vectors(vocabulary: dict[bytes, int]):
    """Length, and number and occurrences of each term asked for, of every document with terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.get
        for batch in batches:
            ids, texts = batch.column(0).fill_null(NO_ID), batch.column(1).cast(pa.binary())
            kept, sizes, terms, counts = [], [], [], []
            for at in range(batch.num_rows):
                words = terms_of(texts[at].as_py())
                if not words:
                    continue
                found = Counter(map(find, words))
                found.pop(None, None)
                kept.append(at)
                sizes.append(len(words))
                terms.append(np.fromiter(found.keys(), np.int32, len(found)))
                counts.append(np.fromiter(found.values(), np.int32, len(found)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                names=["doc", "n", "terms", "counts"],
            )

    return run


def _statistics(size: int):
    """Per task: documents under -1, lengths under -2, documents that hold a term under the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, n, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n += batch.num_rows
            length += int(np.sum(batch.column(0).to_numpy()))
            holding += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(holding)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(np.concatenate([[-1, -2], there]), pa.int32()),
                "value": pa.array(np.concatenate([[n, length], holding[there]]), pa.int64()),
            }
        )

    return run


@dataclass
class Stretch:
    """Some documents and their postings, by document."""

    rows: np.ndarray
    docs: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, documents: int, length: int) -> Stretch:
        """``row, doc, n, terms, counts`` with the impacts that the corpus' lengths give."""
        rows, docs, n = (batch.column(i).to_numpy() for i in range(3))
        sizes = batch.column(3).value_lengths().to_numpy()
        terms = batch.column(3).flatten().to_numpy()
        counts = batch.column(4).flatten().to_numpy().astype(np.int64)
        m = 75 + (25 * n * documents) // length
        impacts = (1_000_000_000 * counts) // (1000 * counts + 12 * np.repeat(m, sizes))
        return Stretch(rows, docs, np.concatenate([[0], np.cumsum(sizes)]), terms, impacts)

    def by_term(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Postings by term: the terms there are, where each begins, and the order."""
        order = np.argsort(self.terms, kind="stable")
        there, starts = np.unique(self.terms[order], return_index=True)
        return there, np.append(starts, len(order)), order

    def matrix(self, size: int) -> np.ndarray:
        """All impacts, documents by terms; ``stretch_rows`` keeps it small."""
        matrix = np.zeros((len(self.rows), size), np.int32)
        matrix[self.owners(), self.terms] = self.impacts
        return matrix

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows)), np.diff(self.bounds))


class Best:
    """The best documents of every question so far, and the score a further one has to reach."""

    def __init__(self, floors: np.ndarray, top: int):
        self.floors, self.top = floors.copy(), top
        self.heaps: list[list] = [[] for _ in floors]
        self.members: list[set] = [set() for _ in floors]

    def offer(self, j: int, score: int, doc: int, row: int) -> None:
        heap, members = self.heaps[j], self.members[j]
        if score <= 0 or score < self.floors[j] or row in members:
            return
        entry = (score, -doc, -row)
        if len(heap) < self.top:
            heapq.heappush(heap, entry)
            members.add(row)
        elif entry > heap[0]:
            members.discard(-heapq.heappushpop(heap, entry)[2])
            members.add(row)
        if len(heap) == self.top and heap[0][0] > self.floors[j]:
            self.floors[j] = heap[0][0]

    def found(self) -> pa.RecordBatch:
        entries = [(j, -r, -d, s) for j, heap in enumerate(self.heaps) for s, d, r in heap]
        columns = list(zip(*entries, strict=True)) or [[]] * 4
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "row", "doc", "score"]
        )


def _opening(asked: Questions, documents: int, length: int, top: int):
    """Exact scores of documents that are rich in a question's rarest terms; largest impacts.

    Any documents would do: their scores only tell what the best have at least.
    """
    rare, factors = [], []
    for j in range(len(asked.ids)):
        terms, factor = asked.weighed(j)
        rare.append(terms[np.argsort(-asked.weights[terms], kind="stable")[:OPENING_TERMS]])
        factors.append(dict(zip(terms.tolist(), factor.tolist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(np.zeros(len(asked.ids), np.int64), top)
        largest = np.zeros(len(asked.weights), np.int64)
        weight = np.zeros(len(asked.weights), np.int64)
        for batch in batches:
            part = Stretch.of(batch, documents, length)
            there, starts, order = part.by_term()
            owners = part.owners()
            np.maximum.at(largest, part.terms, part.impacts)
            at = {t: i for i, t in enumerate(there.tolist())}
            for j, terms in enumerate(rare):
                partial = np.zeros(len(part.rows), np.int64)
                for t in terms.tolist():
                    if t in at:
                        postings = order[starts[at[t]] : starts[at[t] + 1]]
                        partial[owners[postings]] += part.impacts[postings] * factors[j][t]
                promising = np.argsort(-partial, kind="stable")[:top]
                terms_j = list(factors[j])
                weight[terms_j] = list(factors[j].values())
                for row in promising[partial[promising] > 0].tolist():
                    own = slice(part.bounds[row], part.bounds[row + 1])
                    score = int(np.dot(part.impacts[own], weight[part.terms[own]]))
                    best.offer(j, score, int(part.docs[row]), int(part.rows[row]))
                weight[terms_j] = 0
        found = best.found()
        there = np.flatnonzero(largest)
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(np.full(len(there), -1), pa.int32()),
                "row": pa.array(there, pa.int64()),
                "doc": pa.array(np.zeros(len(there)), pa.int64()),
                "score": pa.array(largest[there], pa.int64()),
            }
        )
        yield found

    return run


@dataclass
class Walk:
    """Which questions walk a list, and the coordinates they have."""

    items: np.ndarray
    coordinates: np.ndarray
    factors: np.ndarray  # questions x coordinates


def walks(asked: Questions, largest: np.ndarray) -> dict[int, Walk]:
    """The lists that have to be walked.

    The terms of a question that together can't reach its floor are left out: a document
    with no other term of it is not among the best.
    """
    walkers: dict[int, list[int]] = {}
    for j in range(len(asked.ids)):
        terms, factor = asked.weighed(j)
        most = largest[terms] * factor
        order = np.argsort(most, kind="stable")
        spared = np.cumsum(most[order]) < asked.floors[j]
        for t in terms[order[~spared]].tolist():
            if largest[t]:
                walkers.setdefault(t, []).append(j)
    out = {}
    for t, items in walkers.items():
        weighed = [asked.weighed(j) for j in items]
        coordinates = np.unique(np.concatenate([terms for terms, _ in weighed]))
        factors = np.zeros((len(items), len(coordinates)), np.int64)
        for i, (terms, factor) in enumerate(weighed):
            factors[i, np.searchsorted(coordinates, terms)] = factor
        out[t] = Walk(np.array(items), coordinates, factors)
    return out


def _signed(weights: np.ndarray, walked: np.ndarray):
    """Documents that hold a walked term, with their two rarest terms, by which they are laid out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy()
            terms = batch.column(3).flatten().to_numpy()
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            first, second = np.full(len(sizes), -1, np.int32), np.full(len(sizes), -1, np.int32)
            keep = np.zeros(len(sizes), bool)
            for i in range(len(sizes)):
                own = terms[bounds[i] : bounds[i + 1]]
                keep[i] = walked[own].any()
                if keep[i]:
                    two = own[np.lexsort((own, -weights[own]))[:2]]
                    first[i], second[i] = two[0], two[-1]
            picked = pa.array(np.flatnonzero(keep))
            columns = [c.take(picked) for c in batch.columns]
            columns += [pa.array(first[keep]), pa.array(second[keep])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "first", "second"])

    return run


def clustered(vectors: np.ndarray) -> list[np.ndarray]:
    """Groups of at most ``BLOCK`` similar rows; each row joins the pivot it is nearest to.

    Every ``BLOCK``-th row is a pivot; a larger group is cut in the order of its rows.
    """
    n = len(vectors)
    if n <= BLOCK:
        return [np.arange(n)]
    unit = vectors.astype(np.float32)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)
    nearest = np.argmax(unit @ unit[::BLOCK].T, axis=1)
    order = np.argsort(nearest, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(nearest[order])) + 1)
    return [g[i : i + BLOCK] for g in groups for i in range(0, len(g), BLOCK)]


@dataclass
class Blocks:
    """The blocks of one list in a stretch: members (places in the stretch) and summaries."""

    term: int
    members: np.ndarray
    bounds: np.ndarray
    maxima: np.ndarray  # blocks x coordinates of the walk


def blocks_of(part: Stretch, walked: dict[int, Walk], size: int) -> Iterator[Blocks]:
    """The blocks of every list walked, over the documents of a stretch."""
    matrix = part.matrix(size)
    there, starts, order = part.by_term()
    owners = part.owners()
    for i, t in enumerate(there.tolist()):
        walk = walked.get(t)
        if walk is None:
            continue
        members = owners[order[starts[i] : starts[i + 1]]]
        vectors = matrix[np.ix_(members, walk.coordinates)]
        groups = clustered(vectors)
        picked = np.concatenate(groups)
        bounds = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
        yield Blocks(t, members[picked], bounds, np.maximum.reduceat(vectors[picked], bounds[:-1]))


_BLOCK_KINDS = {
    # the documents of a stretch and their postings
    "rows": np.int64, "docs": np.int64, "bounds": np.int32, "terms": np.int32, "impacts": np.int32,
    # its lists: term, how many blocks and members; its blocks: members, places and maxima of the summary
    "lists": np.int32, "list_blocks": np.int32, "sizes": np.int32, "members": np.int32,
    "summary_sizes": np.int32, "summary": np.int32, "maxima": np.int32,
}
_BLOCK_SCHEMA = ", ".join(f"{name} binary" for name in _BLOCK_KINDS)


def packed(part: Stretch, walked: dict[int, Walk], size: int) -> dict[str, np.ndarray]:
    """A stretch and its blocks as flat columns; a summary keeps the coordinates that are there."""
    out: dict[str, list] = {name: [np.zeros(0, kind)] for name, kind in _BLOCK_KINDS.items()}
    for name in ("rows", "docs", "bounds", "terms", "impacts"):
        out[name].append(getattr(part, name))
    for list_ in blocks_of(part, walked, size):
        block, place = np.nonzero(list_.maxima)
        out["lists"].append([list_.term])
        out["list_blocks"].append([len(list_.maxima)])
        out["sizes"].append(np.diff(list_.bounds))
        out["members"].append(list_.members)
        out["summary_sizes"].append(np.bincount(block, minlength=len(list_.maxima)))
        out["summary"].append(place)
        out["maxima"].append(list_.maxima[block, place])
    return {name: np.concatenate(values).astype(_BLOCK_KINDS[name]) for name, values in out.items()}


def unpacked(columns: dict[str, np.ndarray], walked: dict[int, Walk]) -> tuple[Stretch, list[Blocks]]:
    part = Stretch(*(columns[name] for name in ("rows", "docs", "bounds", "terms", "impacts")))
    lists, at, member, entry = [], 0, 0, 0
    for term, n in zip(columns["lists"].tolist(), columns["list_blocks"].tolist(), strict=True):
        bounds = np.concatenate([[0], np.cumsum(columns["sizes"][at : at + n])])
        counts = columns["summary_sizes"][at : at + n]
        entries = slice(entry, entry + int(counts.sum()))
        maxima = np.zeros((n, len(walked[term].coordinates)), np.int64)
        maxima[np.repeat(np.arange(n), counts), columns["summary"][entries]] = columns["maxima"][entries]
        lists.append(Blocks(term, columns["members"][member : member + bounds[-1]], bounds, maxima))
        at, member, entry = at + n, member + int(bounds[-1]), entries.stop
    return part, lists


def stretch_rows(size: int) -> int:
    """Documents of a stretch: fewer where there are very many terms."""
    return max(1, min(SEGMENT, MATRIX_CELLS // max(size, 1)))


def _blocks(walked: dict[int, Walk], size: int, documents: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = stretch_rows(size)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                columns = packed(Stretch.of(batch.slice(at, step), documents, length), walked, size)
                yield pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()})

    return run


class Searcher:
    """Walks the blocks of stretches; counts how many block visits the bounds spared."""

    def __init__(self, walked: dict[int, Walk], weights: np.ndarray, floors: np.ndarray, top: int):
        self.walked, self.weights, self.best = walked, weights, Best(floors, top)
        self.opened = self.skipped = 0

    def search(self, part: Stretch, lists: list[Blocks]) -> None:
        """Rare terms first: their documents raise the floors that the other lists meet."""
        matrix = part.matrix(len(self.weights))
        for list_ in sorted(lists, key=lambda x: -self.weights[x.term]):
            walk = self.walked[list_.term]
            bounds = list_.maxima @ walk.factors.T
            reached = (bounds > 0) & (bounds >= self.best.floors[walk.items])
            self.opened += int(reached.sum())
            self.skipped += reached.size - int(reached.sum())
            asking = np.flatnonzero(reached.any(0))
            if not len(asking):
                continue
            opened = np.flatnonzero(reached.any(1))
            members = np.concatenate([list_.members[list_.bounds[b] : list_.bounds[b + 1]] for b in opened])
            block = np.repeat(opened, np.diff(list_.bounds)[opened])
            scores = matrix[np.ix_(members, walk.coordinates)].astype(np.int64) @ walk.factors[asking].T
            open_ = reached[np.ix_(block, asking)]
            for column, j in enumerate(walk.items[asking].tolist()):
                own = np.where(open_[:, column], scores[:, column], 0)
                likely = np.flatnonzero((own > 0) & (own >= self.best.floors[j]))
                for i in likely[np.argsort(-own[likely], kind="stable")].tolist():
                    if own[i] < self.best.floors[j]:
                        break
                    self.best.offer(j, int(own[i]), int(part.docs[members[i]]), int(part.rows[members[i]]))


def _searching(walked: dict[int, Walk], weights: np.ndarray, floors: np.ndarray, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(walked, weights, floors, top)
        for batch in batches:
            for at in range(batch.num_rows):
                columns = {
                    name: np.frombuffer(batch.column(i)[at].as_buffer(), kind)
                    for i, (name, kind) in enumerate(_BLOCK_KINDS.items())
                }
                searcher.search(*unpacked(columns, walked))
        yield searcher.best.found()

    return run


def index(spark: SparkSession, vectors: DataFrame, asked: Questions, totals: tuple[int, int], walked: dict[int, Walk]) -> DataFrame:
    """The stored stretches: documents, and the blocks of every list walked."""
    flags = np.zeros(len(asked.weights), bool)
    flags[list(walked)] = True
    kept = vectors.mapInArrow(_signed(asked.weights, flags), f"{_VECTOR_SCHEMA}, first int, second int")
    laid_out = kept.repartitionByRange(partitions(spark), "first", "second", "row")
    laid_out = laid_out.sortWithinPartitions("first", "second", "row").drop("first", "second")
    return staged(laid_out.mapInArrow(_blocks(walked, len(asked.weights), *totals), _BLOCK_SCHEMA), "search-blocks")


_VECTOR_SCHEMA = "row long, doc long, n long, terms array<int>, counts array<int>"
_FOUND_SCHEMA = "item int, row long, doc long, score long"


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best per question; a document that several tasks found counts once."""
    once = found.groupBy("item", "row").agg(F.first("doc").alias("doc"), F.max("score").alias("score"))
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), "doc", "row")
    return once.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)


def _answers(docs: DataFrame, asked: Questions, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    vectors = docs.mapInArrow(_vectors(asked.vocabulary), "doc long, n long, terms array<int>, counts array<int>")
    # written, so that a row keeps its number whatever executor reads it
    vectors = staged(vectors.select(F.monotonically_increasing_id().alias("row"), "*"), "search-vectors")

    counted = vectors.select("n", "terms").mapInArrow(_statistics(len(asked.vocabulary)), "i int, value long")
    counts = {r["i"]: r["value"] for r in counted.groupBy("i").agg(F.sum("value").alias("value")).collect()}
    documents, length = counts.pop(-1, 0), counts.pop(-2, 0)
    if not documents or not counts:
        return None
    asked.weights = np.zeros(len(asked.vocabulary), np.int64)
    for t, holding in counts.items():
        asked.weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))

    opening = staged(vectors.mapInArrow(_opening(asked, documents, length, top), _FOUND_SCHEMA), "search-opening")
    largest = np.zeros(len(asked.vocabulary), np.int64)
    for r in opening.where("item < 0").groupBy("row").agg(F.max("score").alias("most")).collect():
        largest[r["row"]] = r["most"]
    asked.floors = np.zeros(len(asked.ids), np.int64)
    best = _ranked(opening.where("item >= 0"), top)
    for r in best.where(F.col("rank") == top).select("item", "score").collect():
        asked.floors[r["item"]] = r["score"]

    walked = walks(asked, largest)
    blocks = index(spark, vectors, asked, (documents, length), walked)
    found = blocks.mapInArrow(_searching(walked, asked.weights, asked.floors, top), _FOUND_SCHEMA)
    return _ranked(found, top).select("item", "rank", "doc", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_block: int = ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every question.

    ``docs``: ``doc_id, text``; ``items``: ``item_id, text``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    items = items.select("item_id", "text")
    kind = items.schema["item_id"].dataType
    blocks = max(1, -(-items.count() // item_block))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = []
    for block in range(blocks):
        asked = questions([(r[0], r[1]) for r in items.where(place == block).collect()])
        answers = _answers(docs, asked, top) if asked.vocabulary else None
        if answers is None:
            continue
        named = spark.createDataFrame(
            [(i, item) for i, item in enumerate(asked.ids)], f"item int, item_id {kind.simpleString()}"
        )
        parts.append(answers.join(F.broadcast(named), "item"))
    if not parts:
        nothing = F.lit(0).cast("long")
        return items.where("false").select("item_id", F.lit(0).alias("rank"), nothing.alias("doc_id"), nothing.alias("score"))
    doc_id = F.nullif(F.col("doc"), F.lit(NO_ID)).alias("doc_id")
    return union_all([p.select("item_id", "rank", doc_id, "score") for p in parts])


SQL = """
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
totals AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE)))
    AS BIGINT) AS w FROM postings, totals GROUP BY term, documents),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf)
    // (1000 * tf + 12 * (100 - 25 + ((25 * n * documents) // length))))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 20"""
