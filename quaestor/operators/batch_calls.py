"""One call per batch of pairs, as a table function over partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

# The label of each column in the lines of a pair.
LABELS = (("Section", "section"), ("Question", "question"), ("Answer", "ground_truth_answer"), ("Source Passage", "source_passage"),
          ("Question Type", "question_type"))


def batch_function(keys: Sequence[str], call: Callable[[str], str] | None = None):
    """A table function whose table argument is partitioned by ``keys`` and read in the order of ``qa_index``.

    It puts out one row per batch: the keys as they are in the argument, the
    number of pairs and their lines as one text, and with ``call`` the answer
    to that text, or the error that it ended with. Rows of a batch arrive one
    by one; only their lines are kept.
    """
    keys = tuple(keys)

    class Batches:
        @staticmethod
        def analyze(pairs: AnalyzeArgument) -> AnalyzeResult:
            fields = {f.name: f for f in pairs.dataType.fields} if pairs.isTable else {}
            missing = [c for c in (*keys, "qa_index", *(c for _, c in LABELS)) if c not in fields]
            if missing:
                raise ValueError(f"the table argument lacks {', '.join(missing)}")
            schema = T.StructType([fields[k] for k in keys]).add("batch_size", T.LongType()).add("qa_pairs_text", T.StringType())
            if call:
                schema = schema.add("response", T.StringType()).add("error", T.StringType())
            return AnalyzeResult(schema, partitionBy=[PartitioningColumn(k) for k in keys], orderBy=[OrderingColumn("qa_index")])

        def __init__(self):
            self.batch, self.blocks = None, []

        def eval(self, row: T.Row):
            self.batch = tuple(row[k] for k in keys)
            values = ["null" if row[c] is None else row[c] for _, c in LABELS]
            lines = [f"{label}: {value}" for (label, _), value in zip(LABELS, values, strict=True)]
            self.blocks.append("\n".join([f"--- QA Pair {row['qa_index']} ---", *lines, ""]))

        def terminate(self):
            if not self.blocks:
                return
            text, answer = "\n".join(self.blocks), ()
            if call:
                try:
                    answer = (call(text), None)
                except Exception as error:  # a failed batch is a row, not the end of the others
                    answer = (None, f"{type(error).__name__}: {error}")
            yield (*self.batch, len(self.blocks), text, *answer)

    return F.udtf(Batches)


def call_batches(batched: DataFrame, scope: Sequence[str] = (), call: Callable[[str], str] | None = None) -> DataFrame:
    """The batches of ``batched`` (see :func:`quaestor.operators.verify.assign_batches`) through :func:`batch_function`."""
    keys = [*scope, "batch_id"]
    used = batched.select(*keys, "qa_index", *[c for _, c in LABELS])
    return batch_function(keys, call)(used.asTable())
