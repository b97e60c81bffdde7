"""Readers for manifests, project maps, inventories, index snapshots."""
