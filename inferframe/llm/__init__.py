"""Operators of a training-data pipeline over web-scale text, built on Spark.

One module per operator; `textcore` holds the vectorised text kernels that run inside Arrow
batches, `shared` the tables written to the cluster's shared folder, `components` the verified
linking of bucket members. Nothing outside this subpackage imports it.
"""
