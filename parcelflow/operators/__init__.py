"""DataFrame -> DataFrame operators.

* ``dedup``  latest / earliest record per key, time slices, upserts, timestamp standardisation
* ``joins``  anti / semi joins on composite keys, container unpacking, role-playing org joins
* ``lines``  line merge and splice, per-pair timetables, nearest / next departure
* ``route``  route parsing, remaining route, legs, schedule walk
"""

from . import dedup, joins, lines, route  # noqa: F401
