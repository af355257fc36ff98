"""Running maxima over a document without sorting a whole document in one task.

Elements are numbered page by page.  A running maximum is the maximum inside
the page, joined with that of the pages before, for which only one row a page
is ordered by document.  A document that holds a large part of all rows is thus
spread over its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lines import DOC, PAGE


def running_max(df: DataFrame, values: dict[str, Column], inclusive: bool = True, order: str = "elem_ord") -> DataFrame:
    """df with the maximum of each value over the rows of the document up to (or before) each row; nulls are passed over."""
    names = list(values)
    df = df.withColumns({f"_v_{n}": c for n, c in values.items()})
    by_page = df.groupBy(*PAGE).agg(*[F.max(f"_v_{n}").alias(f"_p_{n}") for n in names])
    before = Window.partitionBy(*DOC).orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_page.select(*PAGE, *[F.max(f"_p_{n}").over(before).alias(f"_c_{n}") for n in names])
    own = Window.partitionBy(*PAGE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    df = df.withColumns({n: F.max(f"_v_{n}").over(own) for n in names}).join(carried, PAGE)
    return df.withColumns({n: F.greatest(n, f"_c_{n}") for n in names}).drop(*[f"_{k}_{n}" for n in names for k in "vc"])
