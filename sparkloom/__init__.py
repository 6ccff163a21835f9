"""Spark-native operators for track-style tables and undirected graphs.

Sub-packages:

* ``sources``   - readers (CSV, graph and change-log JSON) and writers
* ``functions`` - column expressions (buckets, labels, member lists, free colours)
* ``operators`` - DataFrame -> DataFrame analyses, and ``operators.graph``
* ``plans``     - whole jobs and the catalogue of checked queries
* ``streaming`` - the change log as a file stream
* ``scratch``   - intermediate results in the cluster's shared folder
"""

__version__ = "0.1.0"
