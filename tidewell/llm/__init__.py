"""Training-data operators: filters, joins, classifiers, scanners and token output.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when it can be imported.
"""
