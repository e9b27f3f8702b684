"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package imports it.  Python that runs inside tasks is
pickled by value (``workspace.by_value``), so executors need no copy of the
package on their path.
"""
