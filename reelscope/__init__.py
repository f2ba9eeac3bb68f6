"""reelscope: rating analytics on Spark DataFrames.

Four related tables (ratings, users, movies, occupations) go in; each
analysis is a small composition of DataFrame operators that returns a
DataFrame.  No result rows are collected to the driver.

Layout:

* ``sources``   - typed schemas, the ``::`` text reader/writer, the
                  star-schema adapter, the materialized layout
* ``functions`` - pure ``Column`` expressions (genres, title year, title name)
* ``operators`` - reusable relational building blocks (stats, joins, top-k)
* ``plans``     - the analyses, reports over shared intermediates, SQL twins
* ``sinks``     - JDBC writer
* ``streaming`` - folder-watching ``::`` source and checkpoint placement
"""

from reelscope.sources.tables import Tables

__all__ = ["Tables"]
