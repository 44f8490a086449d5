"""Starting, watching and stopping streaming queries."""
