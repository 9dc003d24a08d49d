"""Writers and text formats."""
