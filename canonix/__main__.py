"""Batch entry point: ``spark-submit -m canonix`` / ``python -m canonix MAP FOLDER --action ...``.

Runs one action (``unique_values``, ``merge``, ``filter``) or a JSON step list
over the datasets of a folder, then either writes the result (``--output``: a
text folder for value lists, CSV otherwise) or prints a 5-row preview and the
shape. If the map does not exist it is generated from the folder first.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="canonix")
    ap.add_argument("map_path")
    ap.add_argument("data_folder")
    ap.add_argument("--action", required=True, choices=["analyze", "unique_values", "merge", "filter", "steps"])
    ap.add_argument("--canonical_feature")
    ap.add_argument("--filter_value")
    ap.add_argument("--merge_key", help="merge key for filter (default: the map's first feature)")
    ap.add_argument("--steps", help="JSON step list (for --action steps)")
    ap.add_argument("--output", help="write the result here instead of printing a preview")
    args = ap.parse_args(argv)

    from canonix.plans.actions import run_action
    from canonix.plans.workflow import ensure_map
    from canonix.plans.steps import StepEnv, run_steps
    from canonix.model import load_map
    from canonix.session import ensure_checkpoint_dir, hadoop_exists
    from canonix.sources import sinks
    from canonix.sources.tables import load_folder

    spark = SparkSession.builder.appName("canonix").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.action == "analyze":
        # profile + match + report of the folder, written as the map document
        from canonix.operators.report import feature_context, write_map_json
        from canonix.plans.workflow import harmonize_folder

        report, _, _, skipped = harmonize_folder(spark, args.data_folder)
        for name, reason in skipped:
            print(f"skipped {name}: {reason}", file=sys.stderr)
        write_map_json(report, args.map_path)
        for r in feature_context(report).orderBy("section", "ord").collect():  # one line per feature/dataset
            print(r.line)
        return 0
    known = load_map(spark, args.map_path) if hadoop_exists(spark, args.map_path) else None
    datasets, skipped = load_folder(spark, args.data_folder, hmap=known)
    for name, reason in skipped:
        print(f"skipped {name}: {reason}", file=sys.stderr)
    hmap = known or ensure_map(spark, datasets, args.map_path)
    if args.action == "steps":
        if not args.steps:
            ap.error("--steps is required for --action steps")
        result = run_steps(args.steps, StepEnv(spark, hmap, datasets, folder=args.data_folder))
    else:
        # files that are costly to scan are scanned once
        strategy = "auto" if all(n.lower().endswith(".parquet") for n in datasets) else "layout"
        result = run_action(args.action, hmap, datasets, canonical_feature=args.canonical_feature,
                            filter_value=args.filter_value, key=args.merge_key, strategy=strategy)
    if args.output:
        if len(result.columns) == 1:
            sinks.write_text(result, args.output)
        else:
            sinks.write_csv(result, args.output)
    else:
        rows, shape = sinks.preview(result, 5)
        rows.show(truncate=False)
        r = shape.collect()[0]
        print(f"shape: ({r['rows']}, {r['cols']})")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
