"""faceoff — league statistics as Spark jobs.

Nested schedule / roster / team / standings documents are flattened into
typed tables, stored as replaceable snapshots, and queried through
parametrised reports.  Every operator takes and returns Spark DataFrames and
is built from native Column expressions, so Catalyst sees the whole plan.

Sub-packages:

* ``functions``  – Column helpers (clock strings, key normalisation, JSON scalars, safe casts)
* ``sources``    – document and delimited-text readers, document flattening (ingest)
* ``operators``  – reports, keyed-table maintenance, snapshot tables, global ranking
* ``plans``      – refresh jobs and the test-table analog queries
* ``streaming``  – refresh driven by documents arriving in a landing directory
"""

from faceoff.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
