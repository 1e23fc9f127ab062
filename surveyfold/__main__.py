"""Command line: the reference's runner as Spark jobs.

    python -m surveyfold build --sf-dir DIR --out OUT [--panel] [--format csv|parquet] [--publish]
    python -m surveyfold files --codebook X.xml --extract X.dat --crosswalk C.csv \\
        --zone-context Z.csv --soc-structure S.csv --sector-titles T.csv --out OUT [--single-year]
    python -m surveyfold panel --dir OUT_CSV --table state_acs_data --schema "..." --out PANEL [--years 2008-2019]
    python -m surveyfold panels --dir OUT --years 2008-2019 --out PANELS [--format csv|parquet]
    python -m surveyfold hierarchy --structure soc_structure.csv --out OUT

``build`` runs every product on the driver tables (one sample; ``--panel``
keys every table by year). ``files`` runs them on a real extract and its
dimension files. ``panel`` stacks ``{table}_{yyyy}.csv`` files by year;
``panels`` stacks the eight tables of single-year builds in one folder.
``hierarchy`` writes the occupation hierarchy (detailed code with its broad,
minor and major titles) from the structure file.
"""

from __future__ import annotations

import argparse

from .plans.build import build_panels, build_tables, publish_panels, publish_tables
from .plans.products import Survey
from .session import apply_cluster_conf, is_local
from .sources.files import read_panel, write_table


def year_list(text: str) -> list[int]:
    """``2008-2010,2012`` as [2008, 2009, 2010, 2012]."""
    out = []
    for part in text.split(","):
        first, _, last = part.partition("-")
        out += range(int(first), int(last or first) + 1)
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="surveyfold")
    ap.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--panel", action="store_true")
    b.add_argument("--format", default="csv")
    b.add_argument("--publish", action="store_true", help="one build behind a manifest: all tables appear at once")
    f = sub.add_parser("files")
    for name in ("codebook", "extract", "crosswalk", "zone-context", "soc-structure",
                 "sector-titles", "out"):
        f.add_argument(f"--{name}", required=True)
    f.add_argument("--counties")
    f.add_argument("--single-year", action="store_true")
    f.add_argument("--stage-partitions", type=int,
                   help="spread a gzipped (unsplittable) extract before staging it")
    f.add_argument("--format", default="csv")
    f.add_argument("--publish", action="store_true")
    p = sub.add_parser("panel")
    p.add_argument("--dir", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--schema", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--years", type=year_list)
    ps = sub.add_parser("panels")
    ps.add_argument("--dir", required=True)
    ps.add_argument("--years", type=year_list, required=True)
    ps.add_argument("--out", help="the panels' folder; published samples get their panels beside them")
    ps.add_argument("--format", default="csv")
    ps.add_argument("--publish", action="store_true", help="the samples in --dir are published builds")
    h = sub.add_parser("hierarchy")
    h.add_argument("--structure", required=True)
    h.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession
    builder = SparkSession.builder.appName("surveyfold")
    if args.master:
        builder = builder.master(args.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    if not is_local(spark):
        apply_cluster_conf(spark)
    else:
        spark.conf.set("spark.sql.shuffle.partitions", str(2 * int(spark.conf.get("spark.default.parallelism", "8"))))
    if args.cmd == "build":
        survey = Survey.from_driver_tables(spark, args.sf_dir,
                                           ("year",) if args.panel else ())
        (publish_tables if args.publish else build_tables)(survey, args.out, args.format, year_col="YEAR")
    elif args.cmd == "files":
        survey = Survey.from_files(spark, args.codebook, args.extract, args.crosswalk,
                                   args.zone_context, args.soc_structure, args.sector_titles,
                                   args.counties, stage_microdata=True,
                                   stage_partitions=args.stage_partitions)
        (publish_tables if args.publish else build_tables)(
            survey, args.out, args.format, year_col="YEAR" if args.single_year else "MULTYEAR",
            multi_year=not args.single_year)
    elif args.cmd == "panel":
        write_table(read_panel(spark, args.dir, args.table, args.schema, args.years), args.out)
    elif args.cmd == "panels":
        if args.publish:
            publish_panels(spark, args.dir, args.years, args.format)
        elif not args.out:
            ap.error("panels: --out is needed unless --publish is given")
        else:
            build_panels(spark, args.dir, args.out, args.years, args.format)
    else:
        from .sources.files import read_soc_structure
        hier = Survey.occupation_hierarchy(read_soc_structure(spark, args.structure))
        write_table(hier, args.out, order_by=["detailed_soc"])


if __name__ == "__main__":
    main()
