"""``spark-submit run_job.py <job> key=value ...``"""

import sys

from pyspark.sql import SparkSession

from metropulse.plans.jobs import JOBS, run

if __name__ == "__main__":
    if len(sys.argv) < 2:
        raise SystemExit(f"usage: run_job.py <job> key=value ...; jobs: {', '.join(JOBS)}")
    run(SparkSession.builder.appName(f"metropulse {sys.argv[1]}").getOrCreate(), sys.argv[1], sys.argv[2:])
