"""salescope: order analytics as Spark DataFrame plans.

Collect raw per-store order files into one typed fact, clean and enrich it,
and compute target attainment, week-over-week comparisons and movers.
Every function takes and returns DataFrames; nothing is collected.

The main operations, by step:

* ingest / collect: ``read_order_files_checked``, ``collect_orders``,
  ``merge_snapshots``, ``repair_orders``, ``ingest_order_files`` (streaming)
* clean / land: ``clean_orders``, ``write_fact``, ``read_fact``
* attainment: ``department_attainment``, ``platform_attainment``,
  ``operator_attainment``, ``target_status``
* comparisons: ``store_week_compare``, ``product_week_compare``,
  ``store_dimension_week_compare``, ``week_reports``
* movers: ``store_movers``, ``product_movers``
"""

from .operators.cleaning import clean_orders  # noqa: F401
from .plans.attainment import (department_attainment, operator_attainment,  # noqa: F401
                               platform_attainment, target_status)
from .plans.collect import collect_orders, merge_snapshots, repair_orders, seed_targets  # noqa: F401
from .plans.compare import (product_week_compare, store_dimension_week_compare,  # noqa: F401
                            store_week_compare, week_compare, week_reports)
from .plans.movers import product_movers, store_movers  # noqa: F401
from .sinks.files import write_fact  # noqa: F401
from .sources.files import read_fact, read_order_files_checked, read_target  # noqa: F401
from .streaming.ingest import ingest_order_files  # noqa: F401

__version__ = "0.1.0"
