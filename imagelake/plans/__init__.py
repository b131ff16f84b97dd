"""Composed jobs (flagship, uploads, folder evaluation) and the registered queries."""
