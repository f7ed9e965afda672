"""Command line of the pipeline, for ``spark-submit main.py``."""

from ledgerlake.plans.pipeline import main

if __name__ == "__main__":
    main()
