"""DuckDB SQL twins of the batch plan, used only as the correctness oracle.

Helpers return CTE text ``name AS (...)``; ``with_`` joins them.  Names:
``w{k}`` window rows of batch k, ``wm{k}`` its mark, and for a dimension or
table ``X``: ``X_{k}`` = contents after batch k.
"""

from __future__ import annotations

from collections.abc import Sequence

from constella.schemas import MOVIE_ATTRIBUTES


def windows_ctes(n_batches: int, src: str = "silver", ts: str = "date_uploaded",
                 prefix: str = "w", lookback: str | None = None) -> str:
    out = []
    for k in range(1, n_batches + 1):
        upper = f"(SELECT max({ts}) FROM {src} WHERE landing <= {k})"
        lower = ""
        if k > 1:
            mark = f"(SELECT m FROM {prefix}m{k-1})"
            bound = f"{mark} - INTERVAL '{lookback}'" if lookback else mark
            lower = f" AND ({mark} IS NULL OR {ts} > {bound})"
        out.append(f"{prefix}{k} AS (SELECT * FROM {src} WHERE landing <= {k}{lower} AND {ts} <= {upper})")
        prev = "NULL" if k == 1 else f"(SELECT m FROM {prefix}m{k-1})"
        out.append(f"{prefix}m{k} AS (SELECT coalesce(max({ts}), {prev}) AS m FROM {prefix}{k})")
    return ",\n".join(out)


def grow_dim_ctes(name: str, key: str, nk: str, key_type: str, nk_type: str,
                  values: Sequence[str], attrs: Sequence[tuple[str, str]] = ()) -> str:
    """``{name}_0 .. {name}_n``: the dimension after each batch.  ``values[k-1]``
    returns the batch's candidate rows, unique on ``nk`` (plus ``attrs``)."""
    attr_null = "".join(f", CAST(NULL AS {t}) AS {a}" for a, t in attrs)
    attr_sel = "".join(f", s.{a}" for a, _ in attrs)
    out = [f"{name}_0 AS (SELECT CAST(NULL AS {key_type}) AS {key}, CAST(NULL AS {nk_type}) AS {nk}"
           f"{attr_null} WHERE false)"]
    for k, v in enumerate(values, start=1):
        prev = f"{name}_{k-1}"
        out.append(
            f"{name}_{k} AS (SELECT * FROM {prev} UNION ALL "
            f"SELECT CAST(row_number() OVER (ORDER BY s.{nk} NULLS FIRST) "
            f"+ (SELECT coalesce(max({key}), 0) FROM {prev}) AS {key_type}) AS {key}, s.{nk}{attr_sel} "
            f"FROM ({v}) s WHERE NOT EXISTS (SELECT 1 FROM {prev} d WHERE d.{nk} IS NOT DISTINCT FROM s.{nk}))")
    return ",\n".join(out)


def date_attr_sql(c: str) -> str:
    """Calendar attributes in DuckDB terms (``dayofweek`` is 0 = Sunday there)."""
    return (f"CAST(strftime({c}, '%Y%m%d') AS INTEGER) AS date_key, {c} AS date, "
            f"strftime({c}, '%Y-%m-%d') AS date_iso, strftime({c}, '%B %-d, %Y') AS date_full, "
            f"strftime({c}, '%A') AS day_of_week, CAST(dayofmonth({c}) AS INTEGER) AS day_of_month, "
            f"CAST(dayofyear({c}) AS INTEGER) AS day_of_year, CAST(weekofyear({c}) AS INTEGER) AS week_of_year, "
            f"CAST(month({c}) AS INTEGER) AS month, strftime({c}, '%B') AS month_name, "
            f"CAST(quarter({c}) AS INTEGER) AS quarter, CAST(year({c}) AS INTEGER) AS year, "
            f"coalesce(dayofweek({c}) IN (0, 6), false) AS is_weekend")


def grow_date_ctes(name: str, values: Sequence[str]) -> str:
    """Date dimension after each batch; ``values[k-1]`` returns column ``date``."""
    out = [f"{name}_0 AS (SELECT {date_attr_sql('CAST(NULL AS TIMESTAMP)')} WHERE false)"]
    for k, v in enumerate(values, start=1):
        prev = f"{name}_{k-1}"
        out.append(
            f"{name}_{k} AS (SELECT * FROM {prev} UNION ALL SELECT {date_attr_sql('s.date')} "
            f"FROM (SELECT DISTINCT date FROM ({v}) WHERE date IS NOT NULL) s "
            f"WHERE NOT EXISTS (SELECT 1 FROM {prev} d WHERE d.date = s.date))")
    return ",\n".join(out)


# --- the gold tables of the two/three-batch stand-in ---------------------------

def simple_dims_ctes(n: int) -> str:
    ks = range(1, n + 1)
    return ",\n".join([
        grow_dim_ctes("dl", "language_key", "language", "BIGINT", "VARCHAR",
                      [f"SELECT DISTINCT language FROM w{k}" for k in ks]),
        grow_dim_ctes("dr", "runtime_key", "runtime", "BIGINT", "BIGINT",
                      [f"SELECT DISTINCT runtime FROM w{k}" for k in ks]),
        grow_dim_ctes("dra", "rating_key", "rating", "BIGINT", "DOUBLE",
                      [f"SELECT DISTINCT rating FROM w{k}" for k in ks]),
        grow_dim_ctes("dy", "year_key", "year", "BIGINT", "BIGINT",
                      [f"SELECT DISTINCT year FROM (SELECT year FROM w{k} UNION ALL SELECT 4000)" for k in ks]),
    ])


def movie_dim_ctes(n: int) -> str:
    order = ", ".join(f"{a} NULLS FIRST" for a in MOVIE_ATTRIBUTES)
    cols = ", ".join(MOVIE_ATTRIBUTES)
    vals = [f"SELECT slug, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY {order}) AS rn_ "
            f"FROM w{k}) WHERE rn_ = 1" for k in range(1, n + 1)]
    return grow_dim_ctes("dm", "movie_key", "slug", "BIGINT", "VARCHAR", vals,
                         attrs=[(a, "VARCHAR") for a in MOVIE_ATTRIBUTES])


def genre_ctes(n: int) -> str:
    """``dg_k`` (genre dimension) and ``b_k`` (bridge) after each batch."""
    out = [grow_dim_ctes("dg", "genre_id", "genre_name", "INTEGER", "VARCHAR",
                         [f"SELECT DISTINCT unnest(genres) AS genre_name FROM w{k}" for k in range(1, n + 1)])]
    out.append("b_0 AS (SELECT CAST(NULL AS BIGINT) AS movie_id, CAST(NULL AS INTEGER) AS genre_id WHERE false)")
    for k in range(1, n + 1):
        out.append(
            f"b_{k} AS (SELECT * FROM b_{k-1} UNION ALL SELECT DISTINCT p.movie_id, g.genre_id "
            f"FROM (SELECT movie_id, unnest(genres) AS genre_name FROM w{k}) p "
            f"JOIN dg_{k} g ON g.genre_name = p.genre_name "
            f"WHERE NOT EXISTS (SELECT 1 FROM b_{k-1} b WHERE b.movie_id IS NOT DISTINCT FROM p.movie_id "
            f"AND b.genre_id IS NOT DISTINCT FROM g.genre_id))")
    return ",\n".join(out)


FACT_SOURCE = ["imdb_code", "slug", "date_uploaded", "language", "runtime", "rating", "year"]


def fact_ctes(n: int, date_dim: str = "dd") -> str:
    """``f_k``: fact table after each batch (needs the dimension CTEs)."""
    order = ", ".join(["landing"] + [f"{c} NULLS FIRST" for c in FACT_SOURCE])
    out = ["f_0 AS (SELECT CAST(NULL AS BIGINT) AS movie_id, CAST(NULL AS VARCHAR) AS imdb_code, "
           "CAST(NULL AS BIGINT) AS movie_key, CAST(NULL AS INTEGER) AS date_key, "
           "CAST(NULL AS BIGINT) AS language_key, CAST(NULL AS BIGINT) AS runtime_key, "
           "CAST(NULL AS BIGINT) AS rating_key, CAST(NULL AS BIGINT) AS year_key WHERE false)"]
    for k in range(1, n + 1):
        out.append(
            f"fs_{k} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY {order}) AS rn_ "
            f"FROM w{k}) WHERE rn_ = 1)")
        out.append(
            f"fr_{k} AS (SELECT s.movie_id, s.imdb_code, m.movie_key, d.date_key, l.language_key, "
            f"r.runtime_key, ra.rating_key, y.year_key FROM fs_{k} s "
            f"LEFT JOIN dm_{k} m ON m.slug = s.slug "
            f"LEFT JOIN {date_dim}_{k} d ON d.date = s.date_uploaded "
            f"LEFT JOIN dl_{k} l ON l.language = s.language "
            f"LEFT JOIN dr_{k} r ON r.runtime = s.runtime "
            f"LEFT JOIN dra_{k} ra ON ra.rating = s.rating "
            f"LEFT JOIN dy_{k} y ON y.year = s.year)")
        out.append(
            f"f_{k} AS (SELECT * FROM f_{k-1} UNION ALL SELECT * FROM fr_{k} r "
            f"WHERE NOT EXISTS (SELECT 1 FROM f_{k-1} f WHERE f.movie_id = r.movie_id))")
    return ",\n".join(out)


def star_ctes(n: int) -> list[str]:
    """All gold tables after ``n`` batches (windows must precede)."""
    return [simple_dims_ctes(n), movie_dim_ctes(n),
            grow_date_ctes("dd", [f"SELECT date_uploaded AS date FROM w{k}" for k in range(1, n + 1)]),
            genre_ctes(n), fact_ctes(n)]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c.strip())
