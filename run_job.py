"""Entry point for spark-submit; see askgraph/plans/jobs.py."""

from askgraph.plans.jobs import main

if __name__ == "__main__":
    main()
