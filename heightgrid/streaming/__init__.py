"""Left empty on purpose: every capability rebuilt here is a batch job over files.

The one incremental behaviour, "process only what is not written yet", is a batch anti join
(``heightgrid.sources.outputs.pending``).
"""
