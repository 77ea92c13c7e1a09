"""spark-submit entry point: ``spark-submit --py-files postlake.zip scripts/run_job.py clean --input ... --output ...``"""

from postlake.plans.jobs import main

if __name__ == "__main__":
    main()
