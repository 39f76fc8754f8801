"""Command line: ``python -m eventloom {ingest,normalize} ...``.

    python -m eventloom normalize --source-format text --source /landing/raw \
        --contracts eventloom/contracts --sink /tables/normalized [--stream --checkpoint /ckpt]
    python -m eventloom ingest --source github --input-format text --input /landing/pages \
        --sink /tables/raw [--dedupe first|fifo|horizon|none] [--order page_file --order page_pos]
        [--stream --checkpoint /ckpt]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from eventloom.batch import run_ingest, run_normalize
from eventloom.plans.contract import builtin_contracts, load_contracts
from eventloom.session import configure
from eventloom.sources.registry import get_source_config
from eventloom.streaming.jobs import start_ingest, start_normalize


def _options(pairs):
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="eventloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    n = sub.add_parser("normalize")
    n.add_argument("--source-format", default="text")
    n.add_argument("--source", required=True)
    n.add_argument("--option", action="append", help="source option key=value")
    n.add_argument("--contracts", default=None, help="folder of <source>.yml (default: shipped contracts)")
    n.add_argument("--sink", required=True)
    n.add_argument("--output", default="columns", choices=["columns", "json", "wide"])
    i = sub.add_parser("ingest")
    i.add_argument("--source", required=True, help="registry name, e.g. github")
    i.add_argument("--endpoint", default=None)
    i.add_argument("--input-format", default="text")
    i.add_argument("--input", required=True)
    i.add_argument("--option", action="append")
    i.add_argument("--sink", required=True)
    i.add_argument("--dedupe", default="first", choices=["first", "fifo", "horizon", "none"])
    i.add_argument("--order", action="append", default=[],
                   help="SQL expression of the arrival order (repeat for several), e.g. page_file, page_pos")
    for p in (n, i):
        p.add_argument("--stream", action="store_true")
        p.add_argument("--checkpoint", default=None)
        p.add_argument("--trigger-seconds", type=int, default=0, help="0 = availableNow")
    a = ap.parse_args(argv)
    if a.stream and not a.checkpoint:
        ap.error("--stream needs --checkpoint")
    if a.cmd == "ingest":
        if a.dedupe in ("first", "fifo") and not a.order:
            ap.error(f"--dedupe {a.dedupe} needs --order")
        if a.stream and a.dedupe == "first":
            ap.error("--dedupe first keeps every id for ever: stream with fifo or horizon")
    spark = configure(SparkSession.builder.appName(f"eventloom-{a.cmd}").getOrCreate())
    trigger = {"processingTime": f"{a.trigger_seconds} seconds"} if a.trigger_seconds else {"availableNow": True}
    if a.cmd == "normalize":
        contracts = load_contracts(a.contracts) if a.contracts else builtin_contracts()
        if a.stream:
            start_normalize(spark, contracts, source_format=a.source_format, source_path=a.source,
                            source_options=_options(a.option), sink_format="parquet", sink_path=a.sink,
                            checkpoint=a.checkpoint, trigger=trigger, output=a.output).awaitTermination()
        else:
            run_normalize(spark, contracts, source_format=a.source_format, source_path=a.source,
                          source_options=_options(a.option), sink_path=a.sink, output=a.output)
    else:
        cfg = get_source_config(a.source, a.endpoint)
        if a.stream:
            start_ingest(spark, cfg, source_format=a.input_format, source_path=a.input,
                         source_options=_options(a.option), sink_format="parquet", sink_path=a.sink,
                         checkpoint=a.checkpoint, trigger=trigger, dedupe=a.dedupe, order=a.order).awaitTermination()
        else:
            run_ingest(spark, cfg, source_format=a.input_format, source_path=a.input,
                       source_options=_options(a.option), sink_path=a.sink, dedupe=a.dedupe, order=a.order)


if __name__ == "__main__":
    main()
