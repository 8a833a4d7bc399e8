from starflow.sources.broker import broker_options, open_broker
from starflow.sources.tables import (
    append_table,
    open_declared,
    open_if_there,
    open_stream,
    open_table,
    register_views,
    spread,
    stage,
    write_table,
)

__all__ = [
    "append_table",
    "broker_options",
    "open_broker",
    "open_declared",
    "open_if_there",
    "open_stream",
    "open_table",
    "register_views",
    "spread",
    "stage",
    "write_table",
]
