"""tidemark: table contracts, catalog snapshots, schema drift, migration
planning and migration lint as Spark DataFrame operators.

* :mod:`tidemark.functions` - column expressions (normalization, globs,
  identifiers, type names, versions, hashes)
* :mod:`tidemark.sources`   - catalog metadata, script folders, snapshot folders
* :mod:`tidemark.operators` - checks, contracts, drift, render, migrations,
  lint, search, integrity
* :mod:`tidemark.plans`     - end-to-end plans and the registered queries
* :mod:`tidemark.streaming` - contract checks per micro-batch
"""

__version__ = "0.1.0"
