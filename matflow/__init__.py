"""Weekly supply-chain data preparation as Spark DataFrame transformations.

``functions``  column expressions (casts, keys, null rules, predicates, strict sums)
``operators``  DataFrame -> DataFrame steps (frames, lookups, reshaping)
``sources``    record files, spreadsheet grids, snapshots, published tables
``plans``      the dataflows a user runs: orders, forecast, bom, exceptions, inventory, weekly
"""
