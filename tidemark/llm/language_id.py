"""Language identification by compression.

Each language has a zstandard dictionary of raw content, taken from labelled texts.
A text is normalised, cut into blocks, and every block is compressed with every
dictionary; the language with the smallest total wins.  The blocks are compressed
apart, so that a long text keeps leaning on the dictionary and not on itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.inputs import fold

UNDETERMINED = "und"
SAMPLE_DOCUMENTS = 512  # labelled documents per language that a dictionary may use
SAMPLE_CHARS = 512  # of each of them, at a place that its hash chooses
DICTIONARY_BYTES = 4 * SAMPLE_DOCUMENTS * (SAMPLE_CHARS + 1)  # no sample is larger
BLOCK = 4096
# good parses with matches of three bytes and more, the syllables of a language, as far back as dictionaries reach
SEARCH = dict(
    window_log=21, hash_log=17, chain_log=18, search_log=4, min_match=3,
    strategy=zstandard.STRATEGY_BTOPT, write_content_size=False,
)
NARROW = 1  # bytes that the best language must lead by, however short a text is
TRIED = 1024  # whole sampled texts on which the least lead in proportion to the size is chosen
CLEAN = 0.005  # quantile of their leads, of which half must be reached

# ASCII other than letters is a blank; bytes of other characters stay
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def normalised(text: str) -> bytes:
    """Lower-case letters in UTF-8 with single blanks between words."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_PLAIN).split())


@dataclass(frozen=True)
class Model:
    """Raw-content dictionaries by language, the most frequent language first."""

    dictionaries: dict[str, bytes]
    narrow: float = 0.0  # least lead as a share of the best language's compressed size

    def clear(self, lang: str, margin: int, best: int) -> bool:
        """Whether a text of that language, lead and size is accepted."""
        return lang != UNDETERMINED and margin >= max(NARROW, self.narrow * best)

    def compressors(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        """Language and compressor of blocks."""
        search, out = zstandard.ZstdCompressionParameters(**SEARCH), []
        for lang, content in self.dictionaries.items():
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=search)
            out.append((lang, zstandard.ZstdCompressor(compression_params=search, dict_data=shared)))
        return out


def fit(docs: DataFrame) -> Model:
    """Dictionaries from labelled rows outside the held-out fold.

    A bounded sample: ``SAMPLE_DOCUMENTS`` per language, those with the smallest hashes
    of their ids, and of each an excerpt of ``SAMPLE_CHARS`` that begins where a hash says.  A dictionary
    holds all excerpts of its language.  A quarter of the sampled rows, as whole
    texts of whatever length against dictionaries of the rest, shows by how much clean
    texts lead; ``TRIED`` of them at most.  Null texts and null labels are skipped.
    """
    labelled = docs.filter((fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    # a hash below this share leaves about four times what is wanted of each language
    share = F.lit(1.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, 4 * SAMPLE_DOCUMENTS / n)).otherwise(share)
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = (
        labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash"))
        .filter(F.col("hash") / float(1 << 63) <= 2 * share - 1)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= SAMPLE_DOCUMENTS)
    )
    place = F.pmod(F.xxhash64("doc_id", F.lit("excerpt")), F.greatest(F.length("text") - (SAMPLE_CHARS - 1), F.lit(1))) + 1
    tried = max(1, TRIED // max(len(counts), 1))
    rows = (
        labelled.select("doc_id", "text", F.substring("text", place.cast("int"), F.lit(SAMPLE_CHARS)).alias("excerpt"))
        .join(F.broadcast(chosen), "doc_id")  # SAMPLE_DOCUMENTS rows per language
        .select("lang", "place", "excerpt", F.when((F.col("place") % 4 == 0) & (F.col("place") <= 4 * tried), F.col("text")).alias("text"))
        .collect()
    )
    found: dict[str, list[tuple[int, bytes, str | None]]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.place, r.excerpt)):
        found.setdefault(row.lang, []).append((row.place, normalised(row.excerpt), row.text))
    order = sorted(found, key=lambda lang: (-counts[lang], lang))
    return Model(_dictionaries({k: found[k] for k in order}), _least_lead({k: found[k] for k in order}))


def _dictionaries(texts: dict[str, list[tuple[int, bytes, str | None]]], without: int | None = None) -> dict[str, bytes]:
    """All excerpts of each language, or those whose place isn't a multiple of ``without``."""
    joined = {k: b" ".join(x for place, x, _ in own if not without or place % without) for k, own in texts.items()}
    return {k: v[-DICTIONARY_BYTES:] for k, v in joined.items() if len(v) >= 8}


def _least_lead(texts: dict[str, list[tuple[int, bytes, str | None]]]) -> float:
    """Half the ``CLEAN`` quantile of margin by size, of whole texts that are rightly identified."""
    known = _dictionaries(texts, 4)
    if len(known) < 2:
        return 0.0
    compressors, names = Model(known).compressors(), list(known)
    leads = []
    for lang in names:
        for _, _, text in texts[lang]:
            plain = normalised(text) if text else b""
            if plain:
                sizes = _sizes(plain, compressors)
                best, second = np.partition(sizes, 1)[:2]
                if second > best and names[int(sizes.argmin())] == lang:
                    leads.append((second - best) / best)
    return float(np.quantile(leads, CLEAN)) / 2 if leads else 0.0


def _sizes(plain: bytes, compressors) -> np.ndarray:
    """Compressed bytes of a normalised text by language."""
    sizes = np.zeros(len(compressors), np.int64)
    for at in range(0, len(plain), BLOCK):
        block = plain[at : at + BLOCK]
        for k, (_, compressor) in enumerate(compressors):
            sizes[k] += len(compressor.compress(block))
    return sizes


def classify(text: str | None, compressors) -> tuple[str, float, int, int]:
    """``language, score, margin, size`` of one text; the last two in compressed bytes."""
    if not text or not compressors or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0, 0, 0
    plain = normalised(text)
    sizes = _sizes(plain, compressors)
    best = int(sizes.argmin())
    rest = np.delete(sizes, best)
    margin = int(rest.min() - sizes[best]) if len(rest) else int(sizes[best])
    score = 1.0 / float(np.exp2(-np.minimum(sizes - sizes[best], 60.0)).sum())
    return compressors[best][0], score, margin, int(sizes[best])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, margin, accepted`` for every row.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  A text that is
    null or has no letter is ``und`` with score 0 and is not accepted; so is every text
    if no language was learned.  ``score`` weighs the code lengths: one over the sum of
    ``2 ** -(bytes more than the best)``.  A text whose best language leads
    by less than the model asks for its size keeps its prediction but is not accepted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            found = [classify(text, compressors) for text in batch.column(2).to_pylist()]
            lang, score, margin, _ = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [], [])
            accepted = [model.clear(x, m, size) for x, _, m, size in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(margin, pa.int64()),
                    pa.array(accepted, pa.bool_()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "margin", "accepted"],
            )

    return docs.select("doc_id", (fold() == 0).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, margin long, accepted boolean"
    )


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is clear, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = [classify(text, compressors) for text in texts]
            keep = pa.array([model.clear(x, m, size) for x, _, m, size in found], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(run, docs.schema)
