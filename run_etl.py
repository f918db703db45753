"""Launcher for the layered run on a cluster:

    spark-submit --py-files incidex.zip run_etl.py <input dir> [<output root>] [<spec.json>]

(``incidex.zip``: the ``incidex`` package zipped.)  The session takes the
cluster's settings; ``spark.checkpoint.dir`` must name a shared folder.
"""

from incidex.plans.etl import main

if __name__ == "__main__":
    main()
