"""DataFrame operators on the rig log."""
