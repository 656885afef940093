"""Retail sales files to analytics-ready data marts, on Spark.

The usual route through the package::

    paths    = landing.list_files(spark, "s3a://.../landing")
    verdicts = landing.check_files(spark, paths)                      # header gate
    fact     = sales_csv.read_sales(spark, landing.require_accepted(verdicts))   # one typed sales fact
    dims     = Dimensions(customer, store, sales_team)               # measured once
    detail   = enrich(fact, dims)                                    # inner joins
    monthly  = marts.sales_person_incentive(fact, dims)              # ranked totals

``plans.batch.run_batch`` does all of it for one delivery, with the run ledger.
"""
