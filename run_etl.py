"""The session ETL as a submittable job: ``spark-submit --py-files ... run_etl.py [text|parquet]``."""

from visitflow.plans.etl import main

if __name__ == "__main__":
    main()
