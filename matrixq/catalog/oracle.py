"""The same queries as SQL over the given tables."""

from __future__ import annotations

ORDER_PART = """OP as (
    select l_orderkey i, l_partkey j, cast(sum(l_quantity) as bigint) v
    from lineitem group by 1, 2)"""
PART_SUPPLIER = """PS as (
    select l_partkey i, l_suppkey j, cast(sum(l_quantity) as bigint) v
    from lineitem group by 1, 2)"""
ORDER_SUPPLIER = """OS as (
    select l_orderkey i, l_suppkey j, cast(sum(l_quantity) as bigint) v
    from lineitem group by 1, 2)"""
TAX_LESS_DISCOUNT = """TD as (
    select l_partkey i, l_suppkey j, cast(sum(
        cast(round(l_tax * 100) as bigint) - cast(round(l_discount * 100) as bigint)) as bigint) v
    from lineitem group by 1, 2)"""
PART_SIZE = """PF as (
    select p_partkey i, cast(p_size % 10 as bigint) j, cast(p_size as bigint) v from part)"""
VECTORS = """E as (
    select vec_id i, cast(unnest(range(64)) as bigint) j,
        cast(round(cast(unnest(embedding) as double) * 10000) as bigint) v
    from embeddings)"""
CLASS_SUMS = """S as (
    select E.j i, cast(l.label as bigint) j, cast(sum(E.v) as bigint) v
    from E join embeddings l on l.vec_id = E.i group by 1, 2)"""


def _with(*parts: str) -> str:
    return "with " + ", ".join(parts) + " "


def _product(left: str, right: str) -> str:
    return (
        f"select a.i i, b.j j, cast(sum(a.v * b.v) as bigint) v "
        f"from {left} a join {right} b on a.j = b.i group by 1, 2"
    )


def _gram(of: str) -> str:
    return (
        f"select a.j i, b.j j, cast(sum(a.v * b.v) as bigint) v "
        f"from {of} a join {of} b on a.i = b.i group by 1, 2"
    )


def _lines(forms: dict[int, str]) -> str:
    cases = " ".join(
        f"when {number} then replace(replace(replace('{pattern}', 'I', cast(l_orderkey as varchar)),"
        " 'J', cast(l_partkey as varchar)), 'Q', cast(cast(l_quantity as bigint) as varchar))"
        for number, pattern in forms.items()
    )
    return (
        f"L as (select case l_linenumber {cases} else '' end line from lineitem), "
        "P as (select string_split(line, ',') p from L)"
    )


def oracle() -> dict[str, str]:
    from matrixq.catalog.queries import COUNTED_LINES, PERMISSIVE_LINES, STRICT_LINES

    tenths = "cast(round(cast(trim(p[3]) as double) * 10) as bigint) tenths"
    whole_cells = f"select cast(trim(p[1]) as bigint) i, cast(trim(p[2]) as bigint) j, {tenths} from P"
    return {
        "mm_join": _with(ORDER_PART, PART_SUPPLIER) + _product("OP", "PS"),
        "mm_gram_join": _with(ORDER_PART) + _gram("OP"),
        "mm_gram_copartition": _with(ORDER_PART) + _gram("OP"),
        "mm_supplier_gram": _with(PART_SUPPLIER) + _gram("PS"),
        "mm_broadcast": _with(ORDER_PART, PART_SIZE) + _product("OP", "PF"),
        "mm_bucketed": _with(ORDER_PART, ORDER_SUPPLIER)
        + "select a.j i, b.j j, cast(sum(a.v * b.v) as bigint) v "
        "from OS a join OP b on a.i = b.i group by 1, 2",
        "mm_block": _with(VECTORS, CLASS_SUMS) + _product("E", "S"),
        "mm_component_gram_block": _with(VECTORS) + _gram("E"),
        "mm_block_tiles": _with(PART_SUPPLIER) + _gram("PS"),
        "mm_gram_block_tiles": _with(PART_SUPPLIER) + _gram("PS"),
        "mm_hot": """
            with A as (select l_orderkey i, l_linenumber j, sum(cast(l_quantity as bigint)) v
                from lineitem group by 1, 2),
            B as (select l_linenumber i, cast(l_quantity as bigint) j, count(*) v from lineitem group by 1, 2)
            select a.i, b.j, cast(sum(a.v * b.v) as bigint) v from A a join B b on a.j = b.i group by 1, 2""",
        "mm_auto_join": _with(ORDER_PART, PART_SUPPLIER) + _product("OP", "PS"),
        "mm_auto_column_heavy": _with(ORDER_PART, PART_SUPPLIER)
        + "select a.j i, b.i j, cast(sum(a.v * b.v) as bigint) v "
        "from PS a join OP b on a.i = b.j group by 1, 2",
        "mm_cancelled": _with(TAX_LESS_DISCOUNT) + _gram("TD"),
        "mm_cancelled_dropped": _with(TAX_LESS_DISCOUNT)
        + f"select * from ({_gram('TD')}) where v <> 0",
        "mm_auto": _with(ORDER_PART, PART_SUPPLIER) + _product("OP", "PS"),
        "mm_matvec": _with(
            ORDER_PART,
            "PR as (select p_partkey i, cast(0 as bigint) j, "
            "cast(round(p_retailprice * 100) as bigint) v from part)",
        )
        + _product("OP", "PR"),
        "mm_vecmat": _with(
            ORDER_PART,
            "X as (select cast(0 as bigint) i, o_orderkey j, "
            "cast(round(o_totalprice * 100) as bigint) v from orders)",
        )
        + _product("X", "OP"),
        "mm_thin_right": _with(VECTORS, CLASS_SUMS) + _product("E", "S"),
        "mm_sum_rewrite": _with(ORDER_PART, PART_SUPPLIER)
        + "select cast(sum(a.v * b.v) as bigint) total from OP a join PS b on a.j = b.i",
        "product_count": _with(ORDER_PART, PART_SUPPLIER)
        + "select (select count(*) from OP) nnz_a, (select count(*) from PS) nnz_b, "
        "(select count(*) from OP a join PS b on a.j = b.i) products",
        "scale_columns": _with(PART_SUPPLIER, ORDER_SUPPLIER)
        + "select a.i, a.j, cast(a.v * b.s as bigint) v "
        "from PS a join (select j, sum(v) s from OS group by 1) b on a.j = b.j",
        "transpose": _with(PART_SUPPLIER) + "select j i, i j, v from PS",
        "coalesce_sum": _with(ORDER_PART) + "select * from OP",
        "dedup_last": """select i, j, v from (
            select l_orderkey i, l_partkey j, cast(l_quantity as bigint) v, row_number() over (
                partition by l_orderkey, l_partkey order by l_linenumber desc, l_quantity desc) r
            from lineitem) where r = 1""",
        "dedup_error": "select o_orderkey i, o_custkey j, "
        "cast(round(o_totalprice * 100) as bigint) v from orders",
        "drop_zeros": """select i, j, v from (
            select l_partkey i, l_suppkey j, cast(sum(
                cast(round(l_tax * 100) as bigint) - cast(round(l_discount * 100) as bigint)
            ) as bigint) v from lineitem group by 1, 2) where v <> 0""",
        "semi_filter": _with(ORDER_PART, PART_SIZE)
        + "select i, j, v from OP a where exists (select 1 from PF b where b.i = a.j and b.v > 25)",
        "info": _with(ORDER_PART)
        + "select max(i) + 1 n_rows, max(j) + 1 n_cols, count(*) nnz, "
        "count(*) / (cast(max(i) + 1 as double) * (max(j) + 1)) density from OP",
        "index_range": _with(ORDER_PART)
        + "select min(i) min_i, max(i) max_i, min(j) min_j, max(j) max_j from OP",
        "nnz": _with(ORDER_PART) + "select count(*) nnz from OP",
        "total": "select cast(sum(cast(l_quantity as bigint)) as bigint) total from lineitem",
        "row_sums": _with(PART_SUPPLIER)
        + "select i, cast(0 as bigint) j, cast(sum(v) as bigint) v from PS group by 1",
        "column_sums": _with(PART_SUPPLIER)
        + "select cast(0 as bigint) i, j, cast(sum(v) as bigint) v from PS group by 2",
        "index_distinct": "select distinct l_partkey j from lineitem",
        "column_map": _with(ORDER_PART)
        + "select j, count(*) n, cast(sum(v) as bigint) s from OP group by 1",
        "preview": _with(ORDER_PART)
        + """, r as (select distinct i from OP order by i limit 5),
            c as (select distinct j from OP order by j limit 5)
            select r.i, c.j, coalesce(e.v, 0) v from r cross join c
            left join OP e on e.i = r.i and e.j = c.j""",
        "preview_table": _with(VECTORS)
        + """, r as (select distinct i from E order by i limit 5),
            c as (select distinct j from E order by j limit 5)
            select r.i i, string_agg(printf('%.4f', cast(coalesce(e.v, 0) as double)), ' '
                order by c.j) line
            from r cross join c left join E e on e.i = r.i and e.j = c.j group by 1""",
        "sample": _with(ORDER_PART) + "select i, j, v from OP order by i, j limit 5",
        "dense_rows": _with(VECTORS)
        + """select i, cast(64 as integer) width, cast(max(case when j = 0 then v end) as bigint) "first",
            cast(max(case when j = 63 then v end) as bigint) "last", cast(sum(v) as bigint) s
            from E group by 1""",
        "dense_rows_roundtrip": _with(VECTORS) + "select * from E",
        "blocks": _with(VECTORS, "n as (select max(i) + 1 m from E)")
        + """select i // 48 bi, j // 48 bj, least(48, m - (i // 48) * 48) n_rows,
                least(48, 64 - (j // 48) * 48) n_cols, cast(count(*) as integer) n,
                cast(sum(v) as bigint) s
            from E, n group by 1, 2, 3, 4""",
        "block_roundtrip": _with(VECTORS) + "select * from E where v <> 0",
        "coo_text_roundtrip": _with(ORDER_PART) + "select * from OP",
        "parquet_roundtrip": _with(ORDER_PART) + "select * from OP",
        "source_size": _with(ORDER_PART)
        + "select cast(sum(length(cast(i as varchar)) + length(cast(j as varchar)) "
        "+ length(cast(v as varchar)) + 3) as bigint) size_bytes from OP",
        "dense_line_reshape": _with(VECTORS) + "select * from E",
        "dense_line_counted": _with(VECTORS) + "select * from E",
        "parse_permissive": _with(_lines(PERMISSIVE_LINES))
        + """, N as (select round_even(try_cast(trim(p[1]) as double), 0) i,
                round_even(try_cast(trim(p[2]) as double), 0) j,
                try_cast(trim(p[3]) as double) v from P where len(p) = 3)
            select cast(i as bigint) i, cast(j as bigint) j,
                cast(round(v * 10) as bigint) tenths
            from N where i is not null and j is not null and v is not null""",
        "parse_counted": _with(_lines(COUNTED_LINES))
        + f"select * from ({whole_cells} where len(p) = 3) where i >= 0 and j >= 0",
        "parse_strict": _with(_lines(STRICT_LINES)) + whole_cells,
        "mm_rows": _with(ORDER_PART, PART_SUPPLIER) + _product("OP", "PS"),
        "mm_rows_gram": _with(ORDER_PART) + _gram("OP"),
        "mm_rows_long": _with(ORDER_PART)
        + "select a.i, b.j, cast(sum(a.v * b.v) as bigint) v from ("
        "select cast(l_linenumber as bigint) i, l_orderkey j, sum(cast(l_quantity as bigint)) v "
        "from lineitem group by 1, 2) a join OP b on a.j = b.i group by 1, 2",
        "row_products": _with(ORDER_PART, PART_SUPPLIER)
        + "select a.i, cast(sum(n) as bigint) products, count(*) cells "
        "from OP a join (select i, count(*) n from PS group by 1) b on a.j = b.i group by 1",
        "mm_verified": _with(ORDER_PART, PART_SUPPLIER)
        + "select count(distinct a.i) n_rows, cast(0 as bigint) differing from OP a join PS b on a.j = b.i",
        "with_partner_cells": _with(ORDER_PART, PART_SIZE)
        + "select i, j, v from OP a where exists (select 1 from PF b where b.i = a.j and b.v > 25)",
    }
