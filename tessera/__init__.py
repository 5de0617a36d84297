"""tessera: labelled-feature data jobs as Spark DataFrame plans.

Subpackages: ``sources`` (files, text, images, archives, manifests, tables,
sinks), ``functions`` (column expressions), ``operators`` (sampling, vectors,
evaluation, inference, training), ``plans`` (driver queries + SQL oracles),
``streaming`` (incremental scoring of arriving records).
"""

__version__ = "0.1.0"
