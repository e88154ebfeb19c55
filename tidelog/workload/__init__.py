"""An access log derived from the ``events`` table, and every operator run over it."""
