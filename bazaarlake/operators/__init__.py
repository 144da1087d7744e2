"""DataFrame -> DataFrame operators the layers and reports are built from."""
