from fleetdw.streaming.incremental import load_batch, start_fact_stream

__all__ = ["load_batch", "start_fact_stream"]
