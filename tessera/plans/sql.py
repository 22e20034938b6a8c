"""DuckDB SQL text for the registered queries (the correctness oracles).

Built from the same formula code as the DataFrame plans
(:mod:`tessera.functions.dual`), so both engines evaluate the same
floating-point operations. Only the fixture tables are read:
``lineitem``, ``supplier`` and ``nation``.
"""

from __future__ import annotations

from tessera.constants import DEFAULT_MAXZOOM, DEFAULT_MINZOOM, DEFAULT_RESOLUTIONS, INDEX_COLUMNS
from tessera.functions import dual as D
from tessera.functions import grid
from tessera.functions.measures import footprint_m2
from tessera.functions.tiles import continent, quadkey_sql, snap_cell
from tessera.operators.index import derive_metrics
from tessera.sources.fixtures import POPULATION_SQL, footprints_sql

VALID_H = "CASE WHEN height IS NULL OR isnan(height) OR height = -999.0e0 THEN NULL ELSE height END"


def lit(x: float) -> str:
    return D._lit_sql(float(x))


def cte_base() -> list[str]:
    fpm2 = footprint_m2(D.Sql("area_deg2"), D.Sql("lat")).t
    return [
        f"fp AS ({footprints_sql()})",
        f"bm AS (SELECT *, {fpm2} AS fp_m2, {VALID_H} AS h FROM fp)",
        "bmv AS (SELECT *, fp_m2 * h AS vol FROM bm)",
    ]


def _per_res_case(res_col: str, values: dict[int, str]) -> str:
    parts = " ".join(f"WHEN {r} THEN {v}" for r, v in values.items())
    return f"(CASE {res_col} {parts} END)"


def cte_index(name: str, resolutions=DEFAULT_RESOLUTIONS, src: str = "bmv", group_col: str | None = None,
              compat_std: bool = False) -> list[str]:
    """Index rows (h3_res + 11 columns) for ``resolutions`` as CTEs."""
    extra = f"{group_col}, " if group_col else ""
    cells = " UNION ALL ".join(
        f"SELECT {extra}{r} AS h3_res, {grid.cell_sql('lat', 'lon', r)} AS h3_index, fp_m2, h, vol FROM {src}"
        for r in resolutions
    )
    area = _per_res_case("h3_res", {r: lit(grid.SPECS[r].area_km2) for r in resolutions})
    m = derive_metrics(*[D.Sql(c) for c in ("n", "fp", "hsum", "hn", "hsq", "hmax", "vol")], D.Sql(area),
                       compat_std=compat_std)
    metrics = ", ".join(f"{m[c].t} AS {c}" for c in INDEX_COLUMNS[1:])
    return [
        f"{name}_c AS ({cells})",
        f"{name}_a AS (SELECT {extra}h3_res, h3_index, count(*) AS n, sum(fp_m2) AS fp, "
        f"coalesce(sum(h), 0.0e0) AS hsum, count(h) AS hn, coalesce(sum(h * h), 0.0e0) AS hsq, "
        f"max(h) AS hmax, coalesce(sum(vol), 0.0e0) AS vol FROM {name}_c GROUP BY {extra}h3_res, h3_index)",
        f"{name} AS (SELECT CAST(h3_res AS INT) AS h3_res, h3_index, {metrics} FROM {name}_a)",
    ]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def lat_sql(res: int, col: str = "h3_index") -> str:
    return grid.cell_lat_sql(col, res)


def lon_sql(res: int, col: str = "h3_index") -> str:
    return grid.cell_lon_sql(col, res)


def lat_multi(col: str = "h3_index", res_col: str = "h3_res", resolutions=DEFAULT_RESOLUTIONS) -> str:
    return _per_res_case(res_col, {r: grid.cell_lat_sql(col, r) for r in resolutions})


def lon_multi(col: str = "h3_index", res_col: str = "h3_res", resolutions=DEFAULT_RESOLUTIONS) -> str:
    return _per_res_case(res_col, {r: grid.cell_lon_sql(col, r) for r in resolutions})


def index_query(res_list=DEFAULT_RESOLUTIONS, body: str = "SELECT * FROM idx", name: str = "idx", extra=()) -> str:
    return with_(cte_base() + cte_index(name, res_list) + list(extra), body)


# ---------------------------------------------------------------------------
# thinning
# ---------------------------------------------------------------------------


def cte_thinning(minzoom: int = DEFAULT_MINZOOM, maxzoom: int = DEFAULT_MAXZOOM, key: str = "id") -> list[str]:
    """Unrolled thinning loop: picks p_z and remainders r_z, then ``assign``."""
    ctes = [f"r{minzoom} AS MATERIALIZED (SELECT {key}, lon, lat FROM fp)"]
    for z in range(minzoom, maxzoom):
        sx, sy = snap_cell(D.Sql("lon"), D.Sql("lat"), z)
        ctes.append(f"p{z} AS MATERIALIZED (SELECT min({key}) AS {key} FROM r{z} GROUP BY {sx.t}, {sy.t})")
        ctes.append(
            f"r{z + 1} AS MATERIALIZED (SELECT * FROM r{z} WHERE {key} NOT IN (SELECT {key} FROM p{z}))"
        )
    parts = [f"SELECT {key}, {z} AS zoomlevel FROM p{z}" for z in range(minzoom, maxzoom)]
    parts.append(f"SELECT {key}, {maxzoom} AS zoomlevel FROM r{maxzoom}")
    ctes.append("assign AS (" + " UNION ALL ".join(parts) + ")")
    return ctes


def thinning_query(body: str, minzoom: int = DEFAULT_MINZOOM, maxzoom: int = DEFAULT_MAXZOOM) -> str:
    return with_([f"fp AS ({footprints_sql()})"] + cte_thinning(minzoom, maxzoom), body)


def pyramid_rows_sql(maxzoom: int = DEFAULT_MAXZOOM, where: str = "TRUE", cols: str = "*") -> str:
    qk = quadkey_sql("f.lon", "f.lat", maxzoom)
    return thinning_query(
        f"SELECT {cols} FROM (SELECT a.zoomlevel, {qk} AS quadkey, f.source, f.id, CAST(f.height AS FLOAT) AS height, "
        f"CAST(f.var AS FLOAT) AS var, f.region, "
        f"CAST(CASE WHEN f.has_hole THEN 177 ELSE 93 END AS INT) AS geom_bytes "
        f"FROM fp f JOIN assign a ON f.id = a.id WHERE {where})"
    )


def continent_sql(res: int) -> str:
    return continent(D.Sql(lat_sql(res)), D.Sql(lon_sql(res))).t


POPULATION_CTE = f"pop AS ({POPULATION_SQL})"
