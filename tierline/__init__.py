"""tierline: layered lakehouse tables and their reports, built on Spark.

Raw CSV sources land in a typed raw layer under a declared contract, are
cleaned into a conformed layer and enriched into a fact table; every layer is
a versioned table registered in the Spark catalog, and the reports are
DataFrame operators over the fact and its dimensions.

    session     session defaults, checkpoint folder, cluster sizing
    schemas     table contracts and fixed values
    functions   column expressions: dates, measures, filters
    operators   transforms, joins, quality checks, reports
    sources     CSV sources, layer tables, catalog, test view
    plans       pipeline stages, registered queries, SQL oracle
"""

__version__ = "0.1.0"
