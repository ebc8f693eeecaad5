"""Start of the nightly run for spark-submit, from any directory.

    spark-submit bin/nightly.py --root /lake/ledger --folder ZF2526=/data/ZF2526
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerspark.jobs.nightly import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
