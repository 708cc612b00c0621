"""batchwork — periodic batch data work (ledgers, accounts, transactions) on Spark.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function whose
work runs on executors.  Sub-packages:

* ``functions``  column functions (cleaning, dates, report calendar, money rules)
* ``sources``    readers for dated snapshots and legacy feeds
* ``sinks``      table writers, fixed-layout extracts, reports
* ``operators``  keys / joins / aggregation / set / hierarchy / quality operators
* ``rules``      business rule sets held as lookup tables
* ``plans``      end-to-end batch jobs composed from the operators
* ``llm``        operators for training-data pipelines (nothing else imports them)
* ``queries``    the registered queries over the supplied test tables

Task functions are pickled by value, so workers need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.2.0"
