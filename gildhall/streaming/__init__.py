from gildhall.streaming.cdc_stream import dimension_history, initial_load, refresh_dimension

__all__ = ["dimension_history", "initial_load", "refresh_dimension"]
