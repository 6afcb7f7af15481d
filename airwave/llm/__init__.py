"""Training-data operators: thirteen corpus jobs, each a Spark job of its own module.

Nothing outside this subpackage imports it.
"""
