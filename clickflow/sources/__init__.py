"""Sources (table readers, adapters, ad-log line decoding) and sinks."""
