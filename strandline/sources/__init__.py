"""Readers: staging areas, staged newline-JSON, stored tables, manifests."""
