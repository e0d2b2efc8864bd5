"""Table functions from Python functions that yield rows.

For a ``flatMap`` whose function has no built-in form.  Rows go through Python one by one, so
prefer an ``explode`` of built-in functions where there is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeResult


def table_function(f, returns: str):
    """A table function of ``f``, which yields rows (tuples) of the schema ``returns``."""
    class Rows:
        def eval(self, *args):
            yield from f(*args)

    return F.udtf(Rows, returnType=returns)


def flat_map(df: DataFrame, f, returns: str, *arguments) -> DataFrame:
    """Every row of ``df`` beside each row that ``f`` yields for it (``arguments``: columns).

    A row for which ``f`` yields nothing is dropped.  A narrow lateral join: nothing moves.
    """
    columns = [F.col(a) if isinstance(a, str) else a for a in arguments]
    return df.lateralJoin(table_function(f, returns)(*[c.outer() for c in columns]))


def flat_map_by_key(df: DataFrame, keys, step, returns: str, order=()) -> DataFrame:
    """Rows of every key in ``order``, each beside the rows that ``step`` yields for it.

    ``state, found = step(state, row)`` sees a row and what it kept from the row before (None at
    the first of a key), so a key of any size needs one row and one state in memory.  The
    columns of the result follow from ``df``: its own, then ``returns``.
    """
    added, names = StructType.fromDDL(returns), list(df.columns)

    class Rows:
        def __init__(self):
            self.state, self.key = None, None

        @staticmethod
        def analyze(rows):
            return AnalyzeResult(StructType(rows.dataType.fields + added.fields))

        def eval(self, rows):
            key = tuple(rows[k] for k in keys)
            if key != self.key:
                self.state, self.key = None, key
            self.state, found = step(self.state, rows)
            for more in found:
                yield (*(rows[n] for n in names), *more)

    table = df.asTable().partitionBy(*keys)
    return F.udtf(Rows)(table.orderBy(*order) if order else table)
