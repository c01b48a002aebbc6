"""Operators of a training-data pipeline over text tables, each a set of Spark jobs.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries when
the folder is present. Every operator first selects the columns it names, so extra columns
of its input, also ones called like its own results, do not matter.
"""
