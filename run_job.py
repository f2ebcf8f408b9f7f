"""Entry for spark-submit: see `python run_job.py --help`."""

from tiffin.plans.jobs import main

if __name__ == "__main__":
    main()
