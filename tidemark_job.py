"""Launcher for ``spark-submit``: ``spark-submit tidemark_job.py plan|worker ...``.

Executors never import the package (every expression runs in the JVM), so the
driver-side path is all that is needed.
"""

import sys

from tidemark.__main__ import main

if __name__ == "__main__":
    main(sys.argv[1:])
