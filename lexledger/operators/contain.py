"""Which of many patterns a text contains, all of them found in one reading of the text."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Patterns, and characters of patterns, in one automaton (a single longer pattern makes one by itself): a few hundred
#: bytes of a worker's memory each.
BLOCK_PATTERNS, BLOCK_CHARS = 200_000, 4_000_000


def _automaton(patterns: list[str]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for p in patterns:
        made.add_word(p, p)
    made.make_automaton()
    return made


def found_in(texts: DataFrame, patterns: DataFrame, key: str, text: str = "text", pattern: str = "pattern") -> DataFrame:
    """(key, pattern): every pattern that a text contains, once for each row of texts. patterns: a column of that name.

    Patterns are dealt by hash to blocks of bounded size. Each block becomes an Aho-Corasick automaton that tasks build
    for themselves, and every text is read once for each block, so nothing is shuffled and no text is compared with a
    pattern by itself. Null texts contain nothing, null patterns are in nothing, the empty pattern is in every text;
    repeated patterns count once.
    """
    spark = texts.sparkSession
    known = patterns.select(F.col(pattern).alias("p")).where("p IS NOT NULL").distinct()
    size = known.agg(F.count("*"), F.sum(F.length("p"))).first()
    blocks = max(1, -(-size[0] // BLOCK_PATTERNS), -(-(size[1] or 0) // BLOCK_CHARS))
    schema = T.StructType([T.StructField(key, texts.schema[key].dataType), T.StructField(pattern, T.StringType())])
    rows = texts.select(F.col(key), F.col(text).alias("text")).where("text IS NOT NULL")
    out = None
    for block in range(blocks):
        some = spark.sparkContext.broadcast([r["p"] for r in known.where(F.pmod(F.xxhash64("p"), F.lit(blocks)) == block).toLocalIterator()])

        def search(batches, some=some):
            automaton, everywhere = _automaton([p for p in some.value if p]), [""] if "" in some.value else []
            for batch in batches:
                whose, which = [], []
                for k, t in enumerate(batch.column("text").to_pylist()):
                    got = {p for _, p in automaton.iter(t)} if len(automaton) else set()
                    got.update(everywhere)
                    whose += [k] * len(got)
                    which += got
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(whose, pa.int64())), pa.array(which, pa.string())], names=[key, pattern])

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out
