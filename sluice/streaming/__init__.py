"""The relay: sinks, position ledger and the micro-batch with its commit barrier."""
