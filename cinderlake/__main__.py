"""``python -m cinderlake COMMAND``: the engine's steps for a year's folder, in a session of the caller's Spark settings."""

from __future__ import annotations

import argparse
import datetime
import logging

from pyspark.sql import SparkSession

from . import engine
from .config import Layout
from .sources import documents, geopackage, kml_template, kmz

COMMANDS = ("list-fires", "index", "derive-history", "create-template", "create-map", "run")


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cinderlake", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--base", default=".", help="the folder that holds data/YEAR")
    parser.add_argument("--year", type=int, default=datetime.date.today().year)
    parser.add_argument("--force", action="store_true", help="replace a template that may have been edited")
    parser.add_argument("--log-level", default="INFO")
    options = parser.parse_args(arguments)
    logging.basicConfig(level=options.log_level.upper())
    spark = spark or SparkSession.builder.getOrCreate()
    layout = Layout(options.base, options.year)
    if options.command == "create-template":
        written = kml_template.create_template(spark, f"{layout.base.rstrip('/')}/data/templates/Template.kml", options.force)
        return 0 if written else 1
    if options.command == "run":
        engine.run(spark, layout)
        return 0
    known = engine.resolve(spark, layout)
    if options.command == "list-fires":
        for row in known.fires.orderBy("name", "fire_id").toLocalIterator():
            print(row.name, row.status, row.identifier or "-", sep="\t")
    elif options.command == "index":
        documents.write_index(layout.index, engine.index_entries(known, layout))
    else:
        perimeters, points, rings = engine.derive_history(known)
        if options.command == "derive-history":
            geopackage.write(layout.history, {"perimeter_history": engine._layer(perimeters), "point_history": engine._layer(points)})
            geopackage.write(layout.differential, {"perimeter_history": engine._layer(rings), "point_history": engine._layer(points)})
        else:
            template = engine.template_of(spark, layout)
            kmz.write(spark, layout.map_document, kmz.document(kmz.fire_folders(known.fires, perimeters, rings, points, template), template))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
