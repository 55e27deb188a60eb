"""Which example goes to which step and rank, row numbering, shard export."""
