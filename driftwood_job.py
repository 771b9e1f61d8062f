"""spark-submit launcher: ``spark-submit --py-files driftwood.zip driftwood_job.py <command> ...``
(``driftwood.zip`` = the ``driftwood`` package folder zipped)."""

import sys

from driftwood.cli import main

if __name__ == "__main__":
    main(sys.argv[1:])
