"""hearth: listings analytics on PySpark.

Entry points:

* ``hearth.plans.pipeline.clean_listings``  raw feed -> (item_category, listing)
* ``hearth.plans.ingest.ingest``            feed -> validated upsert of both tables
* ``hearth.operators.search``               searches, pages, totals, lookups
* ``hearth.operators.integrity``            the integrity rules as violation rows
* ``hearth.plans.profile_report``           the data-quality profile
* ``hearth.streaming``                      the ingest job per micro-batch of new files
"""

__version__ = "0.1.0"
