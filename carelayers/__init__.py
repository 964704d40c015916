"""Clinical-event preparation on Spark: clean, deduplicate, enrich, roll up, fuse.

Everything is ``DataFrame -> DataFrame`` or ``Column -> Column``; the session is the caller's.
"""
