"""Launcher for spark-submit (which runs a file, not a module):

    spark-submit --py-files shelfcost.zip run_job.py rollup --sources sources.json --target <path> [--month ...]

See :mod:`shelfcost.plans.jobs` for the jobs and their options.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcost.plans.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
