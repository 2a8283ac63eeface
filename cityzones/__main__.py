"""Command line (spark-submit friendly) for the zone runs.

  python -m cityzones lookup   --incidents DIR --districts JSON --neighborhoods JSON --out CSV_DIR
  python -m cityzones format   --landing landing.json --formatted ROOT [--only rent,income,...]
  python -m cityzones ingest   --landing landing.json --formatted ROOT [--only rent,...]
  python -m cityzones kpis     --formatted ROOT --url JDBC_URL --properties props.json [--years Y,..]
  python -m cityzones dataset  --formatted ROOT --out CSV_DIR
  python -m cityzones train    --dataset CSV_DIR --model-base BASE [--seed N] [--split-keys A,B]
  python -m cityzones predict  --dataset CSV_DIR --models ROOT [--name NAME] [--version V] [--split-keys A,B]

``--scratch DIR`` (before the command) names the shared folder for intermediate
files where ``spark.checkpoint.dir`` is not set; they are removed at the end.

``landing.json`` maps the fields of ``cityzones.plans.zones.Landing`` to paths;
``props.json`` holds JDBC properties (user, password, driver).
"""

from __future__ import annotations

import argparse
import json

from cityzones.plans import zones
from cityzones.session import build_session, clear_scratch, scratch_mark


def _list(text: str | None) -> list[str] | None:
    return text.split(",") if text else None


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="cityzones")
    p.add_argument("--scratch", help="shared folder for intermediate files (default: spark.checkpoint.dir)")
    sub = p.add_subparsers(dest="cmd", required=True)
    lk = sub.add_parser("lookup")
    lk.add_argument("--incidents", required=True)
    lk.add_argument("--districts", required=True)
    lk.add_argument("--neighborhoods", required=True)
    lk.add_argument("--out", required=True)
    lk.add_argument("--name-col", default="BARRI")
    lk.add_argument("--district-col", default="DISTRICTE")
    lk.add_argument("--max-distance", type=int, default=2)
    f = sub.add_parser("format")
    f.add_argument("--landing", required=True)
    f.add_argument("--formatted", required=True)
    f.add_argument("--on-unmatched", default="error", choices=["error", "drop", "keep"])
    f.add_argument("--only", help="comma list of income,rent,incidents,neighborhoods")
    g = sub.add_parser("ingest")
    g.add_argument("--landing", required=True)
    g.add_argument("--formatted", required=True)
    g.add_argument("--on-unmatched", default="error", choices=["error", "drop", "keep"])
    g.add_argument("--only", help="comma list of income,rent,incidents")
    k = sub.add_parser("kpis")
    k.add_argument("--formatted", required=True)
    k.add_argument("--url", required=True)
    k.add_argument("--properties", required=True)
    k.add_argument("--mode", default="overwrite")
    k.add_argument("--years", help="comma list, e.g. 2020,2021 (prunes rent folders)")
    d = sub.add_parser("dataset")
    d.add_argument("--formatted", required=True)
    d.add_argument("--out", required=True)
    t = sub.add_parser("train")
    t.add_argument("--dataset", required=True)
    t.add_argument("--model-base", required=True)
    t.add_argument("--seed", type=int, default=42, help="of the forest")
    t.add_argument("--split-keys", help="comma list of columns (default: all text and integer columns)")
    r = sub.add_parser("predict")
    r.add_argument("--dataset", required=True)
    r.add_argument("--models", required=True)
    r.add_argument("--name")
    r.add_argument("--version", help="yyyyMMddHHmmss of a saved version (default: newest)")
    r.add_argument("--split-keys", help="as given to train")
    a = p.parse_args(argv)

    spark = build_session(app=f"cityzones-{a.cmd}", default_checkpoint_dir=a.scratch)
    mark = scratch_mark()
    try:
        run(spark, a)
    finally:
        clear_scratch(spark, mark)


def run(spark, a) -> None:
    if a.cmd == "lookup":
        print(zones.run_incident_lookup(spark, a.incidents, a.districts, a.neighborhoods, a.out,
                                        a.name_col, a.district_col, a.max_distance))
    elif a.cmd == "format":
        with open(a.landing) as fh:
            landing = zones.Landing(**json.load(fh))
        only = a.only.split(",") if a.only else None
        print(json.dumps(zones.run_formatted_zone(spark, landing, a.formatted, a.on_unmatched, only)))
    elif a.cmd == "ingest":
        with open(a.landing) as fh:
            landing = zones.Landing(**json.load(fh))
        only = a.only.split(",") if a.only else None
        print(json.dumps(zones.run_incremental_zone(spark, landing, a.formatted, only, a.on_unmatched)))
    elif a.cmd == "kpis":
        with open(a.properties) as fh:
            props = json.load(fh)
        years = [int(y) for y in a.years.split(",")] if a.years else None
        zones.run_exploitation_zone(spark, a.formatted, a.url, props, a.mode, years)
    elif a.cmd == "dataset":
        print(zones.run_ml_dataset(spark, a.formatted, a.out))
    elif a.cmd == "train":
        path, rmse = zones.run_training(spark, a.dataset, a.model_base, a.seed, split_keys=_list(a.split_keys))
        print(json.dumps({"model": path, "rmse": rmse}))
    elif a.cmd == "predict":
        path, rmse = zones.run_prediction(spark, a.dataset, a.models, a.name, version=a.version,
                                          split_keys=_list(a.split_keys))
        print(json.dumps({"model": path, "rmse": rmse}))


if __name__ == "__main__":
    main()
