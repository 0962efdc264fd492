"""fraudmart: type-2 history, incremental loads and a bank-fraud report on Spark.

Entry points:

* ``fraudmart.plans.daily.run_daily`` — one daily run into a versioned store.
* ``fraudmart.operators`` — the building blocks (``scd2``, ``facts``, ``watermarks``,
  ``context``, ``sequence``, ``rules``, ``report``) as DataFrame → DataFrame functions.
* ``fraudmart.sources`` — extracts, file drops, test fixtures;
  ``fraudmart.streaming`` — file-stream ingestion of drops.
"""

__version__ = "0.1.0"
