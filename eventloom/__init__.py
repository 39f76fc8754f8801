"""eventloom: contract-driven event normalization on Spark.

API events -> raw envelopes (``build_raw_events``) -> de-duplication
(``dedupe_first`` / ``dedupe_fifo`` / ``dedupe_within_horizon``) -> contract
normalization (``normalize``), in batch or Structured Streaming.
"""

from eventloom.batch import run_ingest, run_normalize
from eventloom.operators.dedupe import dedupe_fifo, dedupe_first, dedupe_within_horizon, mark_fifo, mark_first, mark_horizon
from eventloom.operators.ingest import ingest_events
from eventloom.operators.normalize import normalize, quarantine
from eventloom.operators.raw import build_raw_events, encode_raw, envelope_variant, explode_pages
from eventloom.plans.contract import Contract, ContractError, FieldRule, builtin_contracts, load_contracts
from eventloom.session import checkpoint_root, configure
from eventloom.sources.registry import SourceConfig, get_source_config

__all__ = [
    "Contract",
    "ContractError",
    "FieldRule",
    "SourceConfig",
    "build_raw_events",
    "builtin_contracts",
    "checkpoint_root",
    "configure",
    "dedupe_fifo",
    "dedupe_first",
    "dedupe_within_horizon",
    "encode_raw",
    "envelope_variant",
    "explode_pages",
    "get_source_config",
    "ingest_events",
    "load_contracts",
    "mark_fifo",
    "mark_first",
    "mark_horizon",
    "normalize",
    "quarantine",
    "run_ingest",
    "run_normalize",
]
