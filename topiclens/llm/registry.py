"""Names under which the queries of this package are registered, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import queries as Q
from .oracle import SQL


def queries() -> dict:
    own = {name: fn for name, fn in vars(Q).items() if name.startswith("op") and callable(fn)}
    return own | {"pipeline": Q.pipeline}


def oracle_sql() -> dict[str, str]:
    given = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return SQL | given
