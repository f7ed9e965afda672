"""Order-to-finance analytics as plain PySpark DataFrame jobs.

Layers: ``sources`` read the eight order-management tables, ``operators`` model
them (bronze -> silver -> gold -> interface), ``plans`` store them as time-stamped
snapshots and run them in dependency order.
"""
