"""Launcher for spark-submit: ``spark-submit --py-files strata.zip run_batch.py --mode all --raw … --lake …``."""

import sys

from strata.plans.batch_job import main

if __name__ == "__main__":
    sys.exit(main())
