"""Tables, message streams, JSON lines and the star-schema tables as inputs."""
