"""Term and record frequencies by last-seen counters.

Postings are hash-partitioned by token and ordered by record. Then each term needs its occurrences, its records and the last record and posting seen, and no set of
records. Tokens that hold more than a part of a task's fair share, as measured, are spread by their records over as many shards as their load asks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import folded, token_runs
from ledgerloom.operators.balance import SALT, hot_keys, salted
from ledgerloom.session import parallelism


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of runs of (token, salt) in rows ordered by token, salt, record, posting. The last run of a batch stays open: its counter
    is carried over with the last record and posting seen."""
    names = ["token", "occurrences", "records"]
    held: tuple | None = None  # token, salt, occurrences, records, last record, last posting
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        token, salt, record, posting, tf = (batch.column(c) for c in ("token", "salt", "record", "posting", "tf"))
        codes = token.dictionary_encode()
        code = codes.indices.to_numpy(zero_copy_only=False)
        s, r, p, t = (c.to_numpy(zero_copy_only=False) for c in (salt, record, posting, tf))
        new_run = np.concatenate(([True], (code[1:] != code[:-1]) | (s[1:] != s[:-1])))
        new_record = new_run | np.concatenate(([True], r[1:] != r[:-1]))
        new_posting = new_record | np.concatenate(([True], p[1:] != p[:-1]))
        if held and token[0].as_py() == held[0] and s[0] == held[1]:
            new_record[0] = r[0] != held[4]
            new_posting[0] = new_record[0] or p[0] != held[5]
            carried = held[2:4]
        else:
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[2]], pa.int64()), pa.array([held[3]], pa.int64())], names=names)
            carried = (0, 0)
        at = np.flatnonzero(new_run)
        occurrences = np.add.reduceat(np.where(new_posting, t, 0), at)
        records = np.add.reduceat(new_record.astype(np.int64), at)
        occurrences[0] += carried[0]
        records[0] += carried[1]
        held = (token[n - 1].as_py(), s[-1], int(occurrences[-1]), int(records[-1]), r[-1], p[-1])
        if len(at) > 1:
            done = codes.dictionary.take(pa.array(code[at[:-1]]))
            yield pa.RecordBatch.from_arrays([done, pa.array(occurrences[:-1], pa.int64()), pa.array(records[:-1], pa.int64())], names=names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[2]], pa.int64()), pa.array([held[3]], pa.int64())], names=names)


def term_frequencies(postings: DataFrame, rare: int = 2, common: int = 5) -> DataFrame:
    """token, occurrences, records, n_records, mark over postings (posting_id, token, rid, tf).

    Tokens are folded by the search tokeniser; one text may hold several, or none. occurrences is the sum of tf over distinct postings (a redelivered
    row, which has the posting_id of the first, adds nothing), records the number of distinct rid, n_records that of the
    whole table, mark `rare` up to `rare` records, `common` from a 1/`common` of all records on, else null; a token that is both is rare. A null tf counts 0. Rows
    with a null rid or posting_id count as one record or posting of id -1. An empty table gives no rows.
    """
    n = parallelism(postings.sparkSession)
    rows = postings.select(
        F.explode(F.array_distinct(token_runs(folded(F.col("token"))))).alias("token"),
        F.coalesce(F.col("rid").cast("long"), F.lit(-1)).alias("record"),
        F.coalesce(F.col("posting_id").cast("long"), F.lit(-1)).alias("posting"),
        F.coalesce(F.col("tf").cast("long"), F.lit(0)).alias("tf"),
    )
    # Loads of folded tokens, from the rows combined by spelling.
    spelled = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    loads = spelled.select(F.explode(F.array_distinct(token_runs(folded(F.col("token"))))).alias("token"), "n").groupBy("token").agg(F.sum("n").alias("n"))
    rows = salted(rows, ["token"], hot_keys(loads, ["token"], n), ["record"]).withColumnRenamed(SALT, "salt")
    ordered = rows.repartition(n, "token", "salt").sortWithinPartitions("token", "salt", "record", "posting")
    partial = ordered.select("token", "salt", "record", "posting", "tf").mapInArrow(_count, "token string, occurrences long, records long")
    terms = partial.groupBy("token").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    whole = postings.select(F.coalesce(F.col("rid").cast("long"), F.lit(-1)).alias("r")).agg(F.countDistinct("r").alias("n")).first()["n"]
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") * common >= F.lit(whole), "common")
    return terms.select("token", "occurrences", "records", F.lit(whole).cast("long").alias("n_records"), mark.alias("mark"))
