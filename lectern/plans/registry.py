"""Every registered query of the learning-analytics engine, with its DuckDB SQL. Dates leave as ISO strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import activity, engagement, enrollment, enterprise, exports, masking, records, sources, storage, structure, text, validation, video, workflows

_modules = [enrollment, activity, video, engagement, storage, structure, text, validation, exports, masking, records, workflows, sources, enterprise]


def _iso(query):
    def run(spark, sf_dir):
        df = query(spark, sf_dir)
        return df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "date"})

    return run


QUERIES = {k: _iso(v) for m in _modules for k, v in m.QUERIES.items()}
ORACLES = {}
for _m in _modules:
    for _name, _sql in _m.ORACLES.items():
        _dates = getattr(_m, "DATES", {}).get(_name, [])
        ORACLES[_name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _dates)}) FROM ({_sql})" if _dates else _sql
