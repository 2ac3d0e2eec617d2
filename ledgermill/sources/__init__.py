"""Bronze inputs, layer folders and the schemas the silver layer expects."""
