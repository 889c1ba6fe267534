"""Launcher for the batch jobs, e.g.

    spark-submit --py-files wagegrid.zip wagegrid_job.py full-refresh \
        --employees <csv> --timesheets <csv dir> --warehouse <dir>

(``python -m wagegrid.plans.jobs ...`` does the same with a pip-installed PySpark.)
"""

from wagegrid.plans.jobs import main

if __name__ == "__main__":
    main()
