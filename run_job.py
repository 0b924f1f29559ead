"""Job entry for spark-submit; see caredeck/plans/jobs.py."""

from caredeck.plans.jobs import main

if __name__ == "__main__":
    main()
