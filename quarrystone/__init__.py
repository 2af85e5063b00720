"""quarrystone: an analytics project, stage by stage, on Spark DataFrames.

Every operator takes a DataFrame and returns a new one (or a bundle of them).
The stages live in sub-packages:

* ``sources``    files, workbooks and databases in, models out
* ``streaming``  Kafka and landing-zone readers, micro-batches, running totals
* ``operators``  cleansing, exploration, charts, descriptive, diagnostic,
                 modelling and prescriptive operators
* ``functions``  column classes, moments and p-values the operators share
* ``plans``      distributed shapes: exact quantiles, row numbers, framed windows
"""

__version__ = "0.1.0"
