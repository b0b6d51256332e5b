"""The checked queries: every operator run over the driver's tables, with an SQL counterpart."""
