"""File sources and sinks."""
