"""Predictors as plug-ins: a function of a sequence where the rows are, and what it must give."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Takes records (sequence_id, sequence) and gives (sequence_id, score), a row for each.
ScoreProvider = Callable[[DataFrame], DataFrame]
#: Takes records (sequence_id, sequence) and gives (sequence_id, position, score), a row for each residue, from position 1.
ResidueProvider = Callable[[DataFrame], DataFrame]


def provider(predict: Callable[[list[str]], list[float | None]]) -> ScoreProvider:
    """A predictor of sequences as a provider; it runs where the rows are, a batch at a time."""

    def scores(rows: DataFrame) -> DataFrame:
        def each(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(predict(batch.column("sequence").to_pylist()), pa.float64())], names=["sequence_id", "score"])

        slim = rows.select("sequence_id", "sequence")
        return slim.mapInArrow(each, slim.select("sequence_id", F.lit(0.0).alias("score")).schema)

    return scores


def residue_provider(predict: Callable[[str], Sequence[float]]) -> ResidueProvider:
    """A predictor of residues as a provider: a table function over the records, dealt by their ids.

    As many scores as the sequence has residues must come back; another number is an error that names the record. A
    null sequence has no residues.
    """

    def scores(rows: DataFrame) -> DataFrame:
        kind = rows.schema["sequence_id"].dataType.simpleString()

        @F.udtf(returnType=f"sequence_id {kind}, position long, score double")
        class Residues:
            def eval(self, row):
                sequence = row["sequence"] or ""
                found = list(predict(sequence))
                if len(found) != len(sequence):
                    raise ValueError(f"{len(found)} scores for {row['sequence_id']}, which has {len(sequence)} residues")
                for position, score in enumerate(found, 1):
                    yield row["sequence_id"], position, float(score)

        return Residues(rows.select("sequence_id", "sequence").asTable().partitionBy("sequence_id"))

    return scores
