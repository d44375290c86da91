"""The four jobs (``clean``, ``forecast``, ``warning``, ``unscan``), their end-to-end runners with
sinks (``jobs``), the registered queries (``registry``) and their DuckDB twins (``oracle``)."""
