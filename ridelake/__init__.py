"""PySpark jobs for mobility and operations analytics.

Everything is ``DataFrame -> DataFrame``; reading and writing stay in
``ridelake.sources``.  See ``README.md`` for the map of the package.
"""
