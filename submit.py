"""spark-submit entry point for the jobs.

    zip -r pickbay.zip pickbay
    spark-submit --py-files pickbay.zip submit.py {ingest,select,divide,purchase,verify} --help
"""

import sys

from pickbay.plans.cli import main

if __name__ == "__main__":
    sys.exit(main())
