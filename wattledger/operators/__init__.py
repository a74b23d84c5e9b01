"""DataFrame -> DataFrame operators.

All are lazy and unsorted unless ranking is the point. They hint a broadcast only where a constant bounds the rows;
whether other sides are small enough is decided by ``wattledger.plans.sizing`` or by Spark.
"""
