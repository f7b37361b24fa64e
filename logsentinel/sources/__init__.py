"""Sources, decoders, sinks and the test-table adapter."""
