"""Incremental mode for the file-landing stage.

The source pipeline is a periodic batch with no streams, watermarks or state.
The one place where incremental execution helps is S3/S4: new yearly files land
in a folder and must be stacked into the Parquet stage. ``landing.ingest_new_files``
does that with a file-source stream and ``trigger(availableNow=True)``: each run
picks up only files not yet seen (tracked in the stream checkpoint), applies the
same by-name coercion as the batch reader and appends to the stage.
"""
