"""Queries on vectors and coordinate matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import arrays
from tallyloom.operators import matrix
from tallyloom.plans import views
from tallyloom.plans.registry import Tables, query

c = F.col
_AB = f"WITH {views.MATRIX_A}, {views.MATRIX_B}"
_FULL = "FROM a FULL JOIN b ON a.row = b.row AND a.col = b.col"


def _ab(t: Tables) -> tuple[DataFrame, DataFrame]:
    return views.matrix(t, "l_suppkey"), views.matrix(t, "l_partkey")


@query(
    "mat_elementwise",
    f"""{_AB}, j AS (SELECT coalesce(a.row, b.row) AS row, coalesce(a.col, b.col) AS col, coalesce(a.value, 0) AS x,
          coalesce(b.value, 0) AS y {_FULL})
        SELECT 'add' AS op, row, col, CAST(x + y AS BIGINT) AS value FROM j UNION ALL SELECT 'sub', row, col, CAST(x - y AS BIGINT) FROM j
        UNION ALL SELECT 'mul', row, col, CAST(x * y AS BIGINT) FROM j WHERE x * y <> 0
        UNION ALL SELECT 'scale', row, col, CAST(3 * x AS BIGINT) FROM j WHERE x <> 0""",
)
def mat_elementwise(t: Tables) -> DataFrame:
    a, b = _ab(t)
    parts = {
        "add": matrix.mat_add(a, b),
        "sub": matrix.mat_sub(a, b),
        "mul": matrix.stack_product(a, b).where("value <> 0"),
        "scale": matrix.mat_scale(a, 3).where("value <> 0"),
    }
    frames = [df.select(F.lit(op).alias("op"), "row", "col", "value") for op, df in parts.items()]
    return frames[0].union(frames[1]).union(frames[2]).union(frames[3])


@query(
    "vec_dot",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * v)), 6) AS norm2,
         round(list_sum(list_transform(embedding, lambda v: 2 * CAST(v AS DOUBLE))), 6) AS doubled FROM embeddings""",
)
def vec_dot(t: Tables) -> DataFrame:
    x = c("embedding")
    ones = F.transform(x, lambda v: F.lit(1.0))
    twice = arrays.scale(F.transform(x, lambda v: v.cast("double")), 2.0)
    return t.embeddings.select(
        "vec_id", F.round(arrays.dot(x, x), 6).alias("norm2"), F.round(arrays.dot(twice, ones), 6).alias("doubled")
    )


@query(
    "mat_mul",
    f"""{_AB} SELECT a.row, b.row AS col, CAST(sum(a.value * b.value) AS BIGINT) AS value FROM a JOIN b ON a.col = b.col GROUP BY 1, 2""",
)
def mat_mul(t: Tables) -> DataFrame:
    a, b = _ab(t)
    return matrix.mat_mul(a, matrix.transpose(b))


@query("mat_transpose", f"WITH {views.MATRIX_A} SELECT col AS row, row AS col, value FROM a")
def mat_transpose(t: Tables) -> DataFrame:
    return matrix.transpose(_ab(t)[0])


@query(
    "mat_split",
    f"""WITH {views.MATRIX_A} SELECT 'left' AS part, row, col, value FROM a WHERE col < 4 UNION ALL
        SELECT 'right', row, col - 4, value FROM a WHERE col >= 4 UNION ALL SELECT 'upper', row, col, value FROM a WHERE row < 12
        UNION ALL SELECT 'lower', row - 12, col, value FROM a WHERE row >= 12""",
)
def mat_split(t: Tables) -> DataFrame:
    a = _ab(t)[0]
    parts = zip(("left", "right", "upper", "lower"), (*matrix.hsplit(a, 4), *matrix.vsplit(a, 12)))
    frames = [df.select(F.lit(name).alias("part"), "row", "col", "value") for name, df in parts]
    return frames[0].union(frames[1]).union(frames[2]).union(frames[3])


@query(
    "mat_reshape",
    f"""WITH {views.MATRIX_A} SELECT CAST(floor((row * 8 + col) / 5) AS BIGINT) AS row, (row * 8 + col) % 5 AS col, value FROM a""",
)
def mat_reshape(t: Tables) -> DataFrame:
    return matrix.reshape(_ab(t)[0], 8, 5)


@query(
    "mat_stack_sum",
    f"""{_AB} SELECT row, col, CAST(sum(value) AS BIGINT) AS value FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM a)
        GROUP BY 1, 2""",
)
def mat_stack_sum(t: Tables) -> DataFrame:
    a, b = _ab(t)
    return matrix.stack_sum([a, b, a])


@query(
    "mat_all_filter",
    """SELECT l_suppkey AS m FROM (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
       GROUP BY 1 HAVING min(v) > 1700""",
)
def mat_all_filter(t: Tables) -> DataFrame:
    cells = t.lineitem.groupBy(c("l_suppkey").alias("m"), c("l_linenumber").alias("col")).agg(F.sum("l_quantity").alias("value"))
    return matrix.keep_all_above(cells, 1700)


@query(
    "array_mean",
    "SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) / len(embedding), 8) AS mean FROM embeddings",
)
def array_mean(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.round(arrays.array_mean(c("embedding")), 8).alias("mean"))
