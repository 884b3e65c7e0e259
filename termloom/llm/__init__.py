"""Training-data operators.  The core never imports this subpackage."""
