"""Registered queries, each with its SQL counterpart where SQL can state it."""
