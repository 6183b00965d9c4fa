"""strata: trip, corpus and classification analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame built from built-in Spark
functions; the plans are left to Catalyst.  Sub-packages:

* ``sources``   – readers (CSV trips, text lines, document lines, category links), sinks,
                  views of the driver tables
* ``functions`` – column expressions (safe numbers, document-line parsing, tokenizer, logistic)
* ``operators`` – trips, link statistics, text features, kNN, logistic regression
* ``plans``     – the named query catalog, its SQL oracle, and file-in/file-out reports
"""

from strata.session import Scratch, build_session, checkpoint_dir, persist_reliably

__version__ = "0.1.0"

__all__ = ["Scratch", "build_session", "checkpoint_dir", "persist_reliably", "__version__"]
