"""Language identification by compression: a text belongs to the language whose sample, used as a raw-content
zstandard dictionary, compresses it smallest."""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of dictionary for each language, and how many sampled documents they are taken from at most.
DICTIONARY_BYTES = 64 * 1024
SAMPLE_DOCUMENTS = 64
LEVEL = 6
#: Bytes of normalised text that are compressed at a time. The dictionary saves a bounded number of bytes in each
#: piece, so the margin of a long text does not shrink with its length.
PIECE_BYTES = 32 * 1024
#: Where the smallest sizes are equal, the next levels decide.
TIE_LEVELS = (12, 19)
#: Share of the second-best size by which the best must be smaller; below it a document is rejected.
MARGIN = 0.005
UNKNOWN = "und"


def normalised(text: str) -> bytes:
    """Lower-case words separated by single blanks: case, digits and punctuation tell nothing of the language."""
    return (" " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " ").encode("utf-8", "replace")


def has_letter(text: str) -> bool:
    """Whether a text has a letter: what \\p{L} matches when fitting. Other numerals, such as one half, are none."""
    return any(map(str.isalpha, text))


def fit(training: DataFrame, documents: int = SAMPLE_DOCUMENTS, size: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary), the most frequent language first; languages with equal counts by name.

    training: text, lang. Rows without either are not used. Counts cover all rows. The dictionaries come from a
    bounded sample: of each language the ``documents`` distinct texts with the smallest hashes, cut at ``size`` bytes.
    """
    rows = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    # repeated texts count once before the smallest hashes are taken, however many copies there are
    hashed = rows.withColumn("h", F.xxhash64("text"))
    seen = hashed.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("h").alias("texts")).collect()
    counts = {r["lang"]: r["rows"] for r in seen}
    if not counts:
        return []
    # hashes are even, so a share of them holds the smallest; where it holds too few it is doubled
    share, least = {r["lang"]: 8 * documents / max(r["texts"], 1) for r in seen}, {}
    while share:
        limit = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, -(2**63) + min(int(s * 2**64), 2**64 - 1))])
        low: dict[str, list[int]] = {lang: [] for lang in share}
        for r in hashed.where(F.col("h") <= limit[F.col("lang")]).select("lang", "h").distinct().collect():
            low[r["lang"]].append(r["h"])
        least |= {lang: sorted(h)[:documents] for lang, h in low.items()}
        share = {lang: 2 * s for lang, s in share.items() if s < 1 and len(low[lang]) < documents}
    chosen = training.sparkSession.createDataFrame([(lang, h) for lang, hs in least.items() for h in hs], "lang string, h long")
    picked = hashed.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", F.substring("text", 1, size).alias("text")).distinct().collect()
    found = []
    for lang in sorted(counts, key=lambda k: (-counts[k], k)):
        texts = sorted((r["h"], r["text"]) for r in picked if r["lang"] == lang)[:documents]
        found.append((lang, b"".join(normalised(t) for _, t in texts)[:size]))
    return found


def compressors(model: list[tuple[str, bytes]], level: int) -> list:
    made = []
    for _, sample in model:
        d = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def predict(model: list[tuple[str, bytes]]):
    """text -> (language, margin). The margin is the share of the second-best size that the best size is smaller;
    sizes are sums over the pieces of the text."""
    made: dict[int, list] = {}

    def sizes(data: bytes, level: int) -> list[int]:
        if level not in made:
            made[level] = compressors(model, level)
        pieces = [data[at : at + PIECE_BYTES] for at in range(0, len(data), PIECE_BYTES)]
        return [sum(len(c.compress(piece)) for piece in pieces) for c in made[level]]

    def one(text: str | None) -> tuple[str, float]:
        if not model or not has_letter(text or ""):
            return UNKNOWN, 0.0
        data = normalised(text)
        if len(model) == 1:
            return model[0][0], 1.0
        for level in (LEVEL, *TIE_LEVELS):
            got = sizes(data, level)
            best, second = sorted(got)[:2]
            if best < second:
                break
        return model[got.index(best)][0], (second - best) / second

    return one


def identify(docs: DataFrame, model: list[tuple[str, bytes]]) -> DataFrame:
    """docs plus lang_pred and score (the margin, 0 to 1). Only the text is looked at, all of it.

    Null text or text without a letter: ``und``, score 0. Equal sizes at every level: the more frequent language,
    score 0. Input columns named lang_pred or score are replaced. No training rows: everything is ``und``.
    """
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        one = predict(model)
        for batch in batches:
            got = [one(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2
