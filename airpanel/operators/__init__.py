"""DataFrame operators over the panel of (node_id, timestamp) rows."""
