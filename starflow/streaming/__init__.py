from starflow.streaming.landing import LANDED_SCHEMA, envelope, land

__all__ = ["LANDED_SCHEMA", "envelope", "land"]
