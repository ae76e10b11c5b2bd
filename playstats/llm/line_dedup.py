"""Line dedup: lines that many documents share stay in one of them only.

Explode the normalised lines, hash them, count the distinct documents per hash, drop the
lines over the threshold everywhere but in the largest ``doc_id`` that holds them, and
reassemble each text by line position.

Defined results. A null or empty text is one empty line; a null text stays null. Rows that
repeat a ``doc_id`` count as one document, and each row keeps its own text. A row with a
null ``doc_id`` counts as no document, and loses shared lines. An empty table gives an empty
result. Extra columns pass through; input columns named ``n_lines`` or ``n_dropped`` are
replaced.

Scale. The lines are hashed in one pass over the texts (bytes in Python: exact A-Z folding is far
slower on the JVM) and written once as (id, position, hash). The first aggregate is a distinct
count over (hash, doc_id), which Spark spreads by both, so a line found in a third of all
documents is no hot key. The shared hashes are written too, and meet the lines by broadcast after
their rows are counted, else by a join whose hot keys adaptive execution splits. The texts
move once, to meet the positions to drop. Hashes are 128 bits of MD5.
"""

from __future__ import annotations

from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import WHITE_SPACE, small_batches, small_join, write_once


def _long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, row, pos, hash) of every line whose key has ``min_chars`` code points; row is the text's MD5."""
    rows = docs.select(F.col(id_col).alias("_ld_id"), F.col(text_col).cast("string").alias("_ld_text"))
    kind = rows.schema["_ld_id"].dataType.simpleString()
    names = ["_ld_id", "_ld_row", "_ld_pos", "_ld_hash"]

    def lines(batches):
        for batch in small_batches(batches):
            at, row, pos, key = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = [(p, k) for p, line in enumerate((text or "").split("\n"))
                         if len(k := line.strip(WHITE_SPACE)) >= min_chars]
                if found:
                    whole = md5(text.encode()).digest()
                    at += [i] * len(found)
                    row += [whole] * len(found)
                    for p, k in found:
                        pos.append(p)
                        key.append(md5(k.encode().lower()).digest())   # bytes fold A-Z only
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(row, pa.binary()),
                 pa.array(pos, pa.int32()), pa.array(key, pa.binary())], names)

    return rows.mapInArrow(lines, f"_ld_id {kind}, _ld_row binary, _ld_pos int, _ld_hash binary")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with shared lines removed from ``text_col``, plus ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of white space at both ends and lower-cased (A-Z).
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents are kept
    in the largest id only.
    """
    lines = write_once(_long_lines(docs, id_col, text_col, min_chars), "lines")
    shared = write_once(lines.groupBy("_ld_hash")
              .agg(F.countDistinct("_ld_id").alias("_ld_docs"), F.max("_ld_id").alias("_ld_keep"))
              .filter(F.col("_ld_docs") >= min_docs)
              .select("_ld_hash", "_ld_keep"), "shared-lines")
    drops = (small_join(lines, shared, "_ld_hash")
             .filter(~F.col("_ld_id").eqNullSafe(F.col("_ld_keep")))
             .groupBy(F.col("_ld_id").alias("_ld_did"), F.col("_ld_row").alias("_ld_drow"))
             .agg(F.collect_set("_ld_pos").alias("_ld_drop")))
    out = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = (docs.select(*out).withColumn("_ld_row", F.unhex(F.md5(text_col)))
              .join(drops, F.col(id_col).eqNullSafe(F.col("_ld_did"))
                    & (F.col("_ld_row") == F.col("_ld_drow")), "left")
              .withColumn("_ld_lines", F.split(F.coalesce(text_col, F.lit("")), "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), F.col("_ld_drop"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("_ld_lines"), i)), "\n")
    return joined.select(
        *[F.when(F.col("_ld_drop").isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col
          else F.col(c) for c in out],
        F.size("_ld_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_ld_drop"), F.lit(0)).cast("long").alias("n_dropped"))
