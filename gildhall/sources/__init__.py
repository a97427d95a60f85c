from gildhall.sources.scans import blocked, date_spine, extend_dim, live, load_ref, period_spine, seed
from gildhall.sources.sinks import conform, read_table, stamp, write, write_observed
from gildhall.sources.tables import Tables

__all__ = ["blocked", "date_spine", "extend_dim", "live", "load_ref", "period_spine", "seed",
           "conform", "read_table", "stamp", "write", "write_observed", "Tables"]
