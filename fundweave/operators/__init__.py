"""DataFrame -> DataFrame building blocks; actions happen only in gates and sinks."""
