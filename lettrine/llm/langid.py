"""Language ID by compression: the language whose zstandard raw-content dictionary makes a text smallest.

A dictionary is raw text of its language, ``parts`` passages of ``part_chars``
characters from as many labelled documents, spread by hash; that bound is the
training sample. A text is encoded in stretches of ``STRETCH`` bytes, so that a
long one leans on the dictionary throughout and not on itself. The score is the
share by which the smallest total undercuts the next (0 to 1); narrow margins
are rejected.

Null texts and texts without a letter are ``und`` with score 0 and rejected.
With one learned language every other text takes it with score 1, with none
all are ``und``. Ties go to the language first in order. Repeated rows give
repeated results; an empty table gives no rows and no dictionaries; other columns
are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import lean, slices

STRETCH = 2048
UNKNOWN = "und"


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", parts: int = 64, part_chars: int = 1024) -> dict[str, bytes]:
    """A dictionary for each language of the labelled rows: 64 KB at the default bounds, so small enough for the driver."""
    known = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    at = F.pmod("h", F.greatest(F.lit(1), F.length("text") - part_chars + 1)).cast("int") + 1
    chosen = known.groupBy("lang", F.pmod(F.shiftright("h", 17), F.lit(parts)).alias("slot")).agg(F.min(F.struct("h", F.substring(F.col("text"), at, F.lit(part_chars)).alias("part"))).alias("best"))
    joined = chosen.groupBy("lang").agg(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("slot", "best.part"))), lambda x: F.lower(x["part"]))).alias("raw"))
    return {r["lang"]: r["raw"].encode() for r in joined.collect()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = 6, stretch: int = STRETCH):
        import zstandard

        self.langs = sorted(dictionaries)
        self.compressors = []
        self.stretch = stretch
        for name in self.langs:
            raw = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(level=level, dict_data=raw, write_checksum=False, write_content_size=False, write_dict_id=False))

    def classify(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        raw = text.lower().encode("utf-8", "surrogatepass")
        stretches = [raw[i : i + self.stretch] for i in range(0, len(raw), self.stretch)]
        sizes = sorted((sum([len(c.compress(s)) for s in stretches]), name) for c, name in zip(self.compressors, self.langs))
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.005) -> DataFrame:
    """The documents with lang_pred, score and accepted: a language was found and its margin is at least ``min_margin``, at every length.

    Sizes are whole bytes, so a short text needs one byte at least between its languages.
    Columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "accepted")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries)
        for batch in batches:
            found = [classifier.classify(t) for (texts,) in slices([batch], ["text"]) for t in texts]
            added = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[0] != UNKNOWN and f[1] >= min_margin for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "lang_pred", "score", "accepted"])

    return docs.mapInArrow(lean(run), f"{fields}, lang_pred string, score double, accepted boolean")
