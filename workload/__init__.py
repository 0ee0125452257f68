"""The jobs as named queries over the given tables, each with SQL to check it.

The tables are not a scholarly corpus, so a query first derives the shape it needs
(works, ids, files, reports, logs) from whole tables; the SQL does the same.
"""
