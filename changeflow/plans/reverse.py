"""The reverse plan: envelopes → commands → targets → tables and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators.writeback import decode_commands, route_commands
from changeflow.spec import Target


def commands_for(envelopes: DataFrame, targets: Sequence[Target], driver_id: str) -> DataFrame:
    """Decoded commands that are delivered to one driver."""
    return route_commands(decode_commands(envelopes), targets).filter(F.col("driver_id") == driver_id)


def command_columns(cmds: DataFrame, key: dict[str, str], fields: dict[str, str]) -> DataFrame:
    """Typed key and value columns of commands, and ``set`` with the names they supply.

    ``key`` and ``fields`` map column names to types; values come from the ``pk`` and ``fields`` maps.
    A field that is present but NULL is supplied, so an Update can clear a column.
    """
    get = lambda m, n, t: F.try_element_at(F.col(m), F.lit(n)).try_cast(t)
    supplied = F.array_compact(F.array(*[F.when(F.map_contains_key("fields", n), F.lit(n)) for n in fields]))
    return cmds.withColumns(
        {n: get("pk", n, t) for n, t in key.items()}
        | {n: get("fields", n, t) for n, t in fields.items()}
        | {"set": F.coalesce(supplied, F.array().cast("array<string>"))}
    )
